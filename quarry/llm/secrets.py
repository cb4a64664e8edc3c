"""Secret scan through a trigram inverted index, in DataFrame operations only.

From each rule's regular expression a Boolean query over trigrams is derived:
clauses that must all hold, each an alternative of trigram sets. The index has a
posting (trigram, document) for every trigram that some query asks for.
Postings are intersected per alternative, clause and rule; the documents left
are searched with the rule's regular expression. A rule from which no clause
follows (``[0-9a-f]{24,}``) is searched for in every document. Trigrams are
taken from the lower-cased text and pattern, so the index errs only by naming
documents too many, and the search decides.

Defined results: a null text is empty; an empty table gives an empty result;
rows with null or repeated ids are scanned and returned one by one; of the
input's columns only id and text are looked at.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stored

BROADCAST_CANDIDATES = 1_000_000  # about 40 bytes each; beyond it the candidates are joined by a shuffle
MAX_STRINGS = 64  # of one literal part; a part with more variants asks for nothing


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and without overlap; those whose ``group`` has under ``least`` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base rules, in the order in which spans of one start are listed.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Public formats of further credentials.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES

Clause = frozenset  # of alternatives, each a frozenset of trigrams that must all occur


def _trigrams(s: str) -> frozenset[str]:
    return frozenset(s[i : i + 3] for i in range(len(s) - 2))


def _strings(items) -> set[str] | None:
    """All strings that a parsed part matches (lower case), or None if they are too many to list."""
    out = {""}
    for op, arg in items:
        if op is sre.LITERAL:
            part = {chr(arg).lower()}
        elif op is sre.SUBPATTERN:
            part = _strings(arg[-1])
        elif op is sre.BRANCH:
            parts = [_strings(b) for b in arg[1]]
            part = None if None in parts else set().union(*parts)
        elif op is sre.IN:
            if any(k is not sre.LITERAL for k, _ in arg):
                return None
            part = {chr(c).lower() for _, c in arg}
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] != sre.MAXREPEAT and arg[1] <= 8:
            one = _strings(arg[2])
            part = None
            if one is not None and len(one) ** arg[1] <= MAX_STRINGS:
                part, power = set(), {""}
                for n in range(arg[1] + 1):
                    part |= power if n >= arg[0] else set()
                    power = {a + b for a in power for b in one}
        elif op is sre.AT:
            part = {""}
        else:
            part = None
        if part is None or len(out) * len(part) > MAX_STRINGS:
            return None
        out = {a + b for a in out for b in part}
    return out


def _clauses(items) -> set[Clause]:
    """Clauses that every match of a parsed part satisfies."""
    found: set[Clause] = set()
    run: set[str] = {""}

    def close() -> None:
        nonlocal run
        if all(len(s) >= 3 for s in run):
            sets = {_trigrams(s) for s in run}
            found.add(frozenset(a for a in sets if not any(b < a for b in sets)))  # a larger set asks for nothing new
        run = {""}

    for item in items:
        part = _strings([item])
        if part is not None and len(run) * len(part) <= MAX_STRINGS:
            run = {a + b for a in run for b in part}
            continue
        close()
        op, arg = item
        if part is not None:
            run = part
        elif op is sre.SUBPATTERN:
            found |= _clauses(arg[-1])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] >= 1:
            found |= _clauses(arg[2])
        elif op is sre.BRANCH:
            each = [_clauses(b) for b in arg[1]]
            if all(each):  # one clause of every branch, as alternatives
                found.add(frozenset().union(*(min(c, key=len) for c in each)))
    close()
    return found


def trigram_query(pattern: str) -> list[Clause]:
    """The Boolean trigram query of a regular expression: all clauses must hold; empty if none is mandatory."""
    return sorted(_clauses(list(sre_parser.parse(pattern))), key=lambda c: sorted(map(sorted, c)))


def candidates(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, rules): for each document of ``texts`` (doc_id, text) the indexed rules whose query its postings satisfy."""
    spark = texts.sparkSession
    asked = []
    for r in rules:
        for c, clause in enumerate(query := trigram_query(r.pattern)):
            for a, grams in enumerate(sorted(clause, key=sorted)):
                asked += [(g, r.kind, len(query), c, a, len(grams)) for g in sorted(grams)]
    wanted = spark.createDataFrame(asked, "gram string, rule string, clauses int, clause int, alternative int, grams int")
    present = F.array_compact(F.array(*[F.when(F.contains(F.col("low"), F.lit(g)), F.lit(g)) for g in sorted({x[0] for x in asked})]))
    postings = texts.select("doc_id", F.lower("text").alias("low")).select("doc_id", F.explode(present).alias("gram"))
    return (
        postings.join(F.broadcast(wanted), "gram")  # as many rows as the rules have trigrams
        .groupBy("doc_id", "rule", "clauses", "clause", "alternative", "grams").agg(F.countDistinct("gram").alias("n"))
        .where("n = grams")
        .groupBy("doc_id", "rule", "clauses").agg(F.countDistinct("clause").alias("n"))
        .where("n = clauses")
        .groupBy("doc_id").agg(F.collect_set("rule").alias("rules"))
    )


def _spans(rule: Rule, order: int, text: Column) -> Column:
    """Spans (start, order, end, kind) of a rule's matches in code points, from the texts of and between them."""
    pattern = F.lit(rule.pattern)
    whole, between = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, rule.pattern)
    parts = F.arrays_zip(whole.alias("m"), between.alias("b"), F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("g"))
    span = "struct<start:int,order:int,end:int,kind:string>"
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["b"])
        end = start + F.char_length(x["m"])
        new = F.array(F.struct(start.alias("start"), F.lit(order).alias("order"), end.alias("end"), F.lit(rule.kind).alias("kind")))
        good = x["m"].isNotNull() & (F.char_length(x["g"]) >= rule.least)
        return F.struct(
            F.coalesce(end, acc["at"]).alias("at"),
            F.when(good, F.concat(acc["spans"], new)).otherwise(acc["spans"]).cast(f"array<{span}>").alias("spans"),
        )

    found = F.aggregate(parts, empty, step, lambda acc: acc["spans"])
    return F.when(F.rlike(text, pattern), found).otherwise(F.array().cast(f"array<{span}>"))


def scan(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text",
    broadcast_candidates: int = BROADCAST_CANDIDATES,
) -> DataFrame:
    """(doc_id, spans) per document; ``spans`` is an array of (start, order, end, kind) by start, then rule.

    Starts and ends count code points, ends are exclusive.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    named = stored(candidates(texts, rules), "secret-candidates")
    few = named.count() <= broadcast_candidates
    named = F.broadcast(named) if few else named
    joined = texts.alias("a").join(named.alias("b"), F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")), "left")
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    each = []
    for i, r in enumerate(rules):
        spans = _spans(r, i, F.col("text"))
        each.append(F.when(F.array_contains("rules", r.kind), spans).otherwise(none) if trigram_query(r.pattern) else spans)
    return joined.select(F.col("a.doc_id").alias("doc_id"), F.sort_array(F.concat(*each)).alias("spans"))


def digest(found: DataFrame, base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """Counts per base rule, the SHA-256 of the base spans, and all spans as text."""

    def written(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    kinds = [r.kind for r in base]
    return found.select(
        "doc_id", *[number(r.kind) for r in base],
        F.sha2(written(F.filter("spans", lambda s: s["kind"].isin(kinds))), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def brute_force(text: str | None, rules: tuple[Rule, ...] = RULES) -> list[tuple[int, int, int, str]]:
    """The spans of one text by Python's regular expressions; what the tests compare with."""
    return sorted(
        (m.start(), i, m.end(), r.kind)
        for i, r in enumerate(rules) for m in re.finditer(r.pattern, text or "") if len(m[r.group]) >= r.least
    )
