"""Rewriting texts by a table: at every place the longest entry, from left to right. Arrow-batched, one automaton a worker."""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql.functions import arrow_udf

#: Entries of a table at most (it is sent to every worker), characters that are rewritten at once.
MAX_ENTRIES, STEP = 1_000_000, 1 << 16


def table_of(df: DataFrame, word: str, to: str) -> dict[str, str]:
    """A table's entries: empty words are left out, of repeated ones the least replacement counts; more than MAX_ENTRIES are an error."""
    rows = df.where(f"`{word}` <> '' and `{to}` is not null").groupBy(word).agg({to: "min"}).toDF("w", "t").limit(MAX_ENTRIES + 1).collect()
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"more than {MAX_ENTRIES} entries")
    return {r["w"]: r["t"] for r in rows}


@lru_cache(maxsize=4)
def _automaton(entries: tuple[tuple[str, str], ...]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for word, to in entries:
        found.add_word(word, (len(word), to))
    found.make_automaton()
    return found


def rewritten(text: str, entries: tuple[tuple[str, str], ...]) -> str:
    """``text`` with every leftmost longest entry replaced; what was written isn't read again."""
    if not entries:
        return text
    automaton, longest = _automaton(entries), max(len(w) for w, _ in entries)
    out, at = [], 0
    while at < len(text):
        # a match that starts near the end of a step may be part of a longer one
        stop = min(len(text), at + max(STEP, 2 * longest))
        sure = stop if stop == len(text) else stop - longest
        done = at
        for end, (size, to) in automaton.iter_long(text[at:stop]):
            start = at + end - size + 1
            if start >= sure:
                break
            out += text[done:start], to
            done = start + size
        out.append(text[done : max(done, sure)])
        at = max(done, sure)
    return "".join(out)


def rewrite(text: Column, table: dict[str, str]) -> Column:
    """``text`` by a table of words and what they become (as table_of gives it); null stays null."""
    entries = tuple(sorted((w, t) for w, t in table.items() if w))

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else rewritten(t, entries) for t in texts.to_pylist()], pa.string())

    return arrow_udf(run, "string")(text)
