"""Streaming form of the word count: a directory that keeps receiving text files.

The batch questions have no streaming counterpart; the word count is the one
job whose input (a directory of text files) naturally grows.
"""

from quarry.streaming.wordcount import current_counts, start_word_count, word_count_stream  # noqa: F401
