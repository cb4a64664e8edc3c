from quarry.sources.tables import TABLES, table  # noqa: F401
from quarry.sources.delimited import (  # noqa: F401
    HIVE_TEXT_SEP,
    join_fields,
    read_delimited,
    read_hive_text,
    read_lines,
    read_split_text,
    split_to_schema,
)
from quarry.sources.json import read_json  # noqa: F401
from quarry.sources.rows import rows_frame, schema_from_json, schema_json, schema_tree  # noqa: F401
