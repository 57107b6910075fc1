"""Benchmark decontamination with an Aho-Corasick automaton over normalised benchmark passages.

Normal form: A-Z lower-cased, words of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` joined by one space. Each item gives its windows
of ``window`` consecutive words (or the whole item if it has fewer). The windows of all items make one automaton, which
reads each normalised text once; an occurrence is a run of words, and words map back to offsets in the original text.

The items are counted first. Up to ``max_chars`` characters of windows make one automaton (a broadcast of proven size);
a larger benchmark is dealt into as many blocks by item id, each with an automaton of its own in a pass of its own, and
the passes are chained without a shuffle, each adding to a row's hits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import require, text_slices

#: Words in a window.
WINDOW = 10
#: Characters of windows in one automaton; bounds the broadcast and each worker's automaton (about 60 bytes a character).
MAX_CHARS = 4_000_000

#: Words in a text whose letters are not lower-cased yet; everything else in ASCII separates words.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Bytes to bytes of the normal form: A-Z to a-z, separators to a space, the rest stays.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def normal_words(text: str) -> list[str]:
    return [w.decode() for w in text.encode().translate(_FOLD).split()]


def windows(words: Sequence[str], size: int) -> list[tuple[str, ...]]:
    if not words:
        return []
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


_built: list = [None, None]


def _automaton(patterns: dict[str, list[str]]):
    """The automaton of a broadcast's patterns, built once in a worker."""
    import ahocorasick

    if _built[0] is not patterns:
        a = ahocorasick.Automaton()
        for text, items in patterns.items():
            a.add_word(f" {text} ", (len(text) + 2, text.count(" ") + 1, items))
        a.make_automaton()
        _built[:] = patterns, a
    return _built[1]


def merge_runs(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for a, b in sorted(runs):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return [(a, b) for a, b in merged]


def find_hits(automaton, text: str) -> tuple[int, list[tuple[int, int]], list[str]]:
    """Words of a text, merged runs of hit words (first, past the last), and the items found. The text is read once."""
    norm = b" ".join(text.encode().translate(_FOLD).split()).decode()
    if not norm:
        return 0, [], []
    norm = f" {norm} "
    runs: list[tuple[int, int]] = []
    items: set[str] = set()
    at = words = 0
    for end, (size, count, names) in automaton.iter(norm):
        start = end - size + 1
        if start >= at:
            words += norm.count(" ", at, start + 1)
            first = words - 1
            at = start + 1
        else:  # a longer window that began earlier ends here
            first = words - 1 - norm.count(" ", start + 1, at)
        runs.append((first, first + count))
        items.update(names)
    return norm.count(" ") - 1, merge_runs(runs), sorted(items)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id",), item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, max_chars: int = MAX_CHARS, spans: bool = True
) -> DataFrame:
    """Which words of every text lie in an occurrence of a benchmark window.

    Returns the ``keep`` columns, then ``n_words`` long, ``n_hit`` long, ``items`` array<string> (ids of items with
    occurring windows, as sorted strings) and, with ``spans``, ``hit_spans`` array<struct<start,end>> (offsets in code
    points of the original text, merged where hit words adjoin). Null or empty texts and items have no words, hence no
    hits; an item with a null id is left out; rows that repeat are each answered; an empty benchmark hits nothing; other
    columns are ignored whatever their names.
    """
    require(docs, text_col, *keep)
    require(benchmark, item_col, item_text)
    if clash := {k.lower() for k in keep} & {"n_words", "n_hit", "items", "hit_spans", "hit_text", "hit_runs"}:
        raise ValueError(f"kept columns named as results: {', '.join(sorted(clash))}")
    spark = docs.sparkSession
    bench = benchmark.where(F.col(item_col).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item_col).cast("string").alias("item"), F.col(item_text).alias("body"))
    chars = bench.agg(F.sum(F.length("body").cast("long"))).first()[0] or 0
    blocks = max(1, -(-chars * window // max_chars))
    keep, n = list(keep), len(keep)
    run = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("past", T.LongType())]))
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    arrow_run, arrow_span = (pa.list_(pa.struct([(a, pa.int64()), (b, pa.int64())])) for a, b in (("first", "past"), ("start", "end")))
    out = docs.select(*keep, F.col(text_col).alias("hit_text"), F.array().cast(run).alias("hit_runs"), F.array().cast("array<string>").alias("items"))
    for block in range(blocks):
        rows = bench if blocks == 1 else bench.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        patterns: dict[str, list[str]] = {}
        for row in rows.distinct().toLocalIterator():
            for w in windows(normal_words(row.body), window):
                patterns.setdefault(" ".join(w), []).append(row.item)
        sent = spark.sparkContext.broadcast({p: sorted(set(i)) for p, i in patterns.items()})
        last = block == blocks - 1
        given = ["n_words", "n_hit", "items", *(["hit_spans"] if spans else [])] if last else ["hit_text", "hit_runs", "items"]
        kinds = {"n_words": T.LongType(), "n_hit": T.LongType(), "items": T.ArrayType(T.StringType()), "hit_spans": span, "hit_text": T.StringType(), "hit_runs": run}
        schema = T.StructType([*(docs.schema[k] for k in keep), *(T.StructField(g, kinds[g]) for g in given)])

        def scan(batches: Iterator[pa.RecordBatch], sent=sent, last=last, given=given) -> Iterator[pa.RecordBatch]:
            automaton = _automaton(sent.value) if sent.value else None
            for batch in text_slices(batches):
                made: dict[str, list] = {g: [] for g in ("n_words", "n_hit", "items", "hit_spans", "hit_runs")}
                for body, old, had in zip(*(batch.column(n + i).to_pylist() for i in range(3)), strict=True):
                    count, found, names = find_hits(automaton, body or "") if automaton else (len(normal_words(body or "")), [], [])
                    if old:
                        found = merge_runs([(r["first"], r["past"]) for r in old] + found)
                    at = [m.span() for m in WORD.finditer(body)] if found and last and spans else []
                    made["n_words"].append(count)
                    made["n_hit"].append(sum(b - a for a, b in found))
                    made["items"].append(sorted({*had, *names}))
                    made["hit_spans"].append([{"start": at[a][0], "end": at[b - 1][1]} for a, b in found] if at else [])
                    made["hit_runs"].append([{"first": a, "past": b} for a, b in found])
                arrays = {"n_words": pa.int64(), "n_hit": pa.int64(), "items": pa.list_(pa.string()), "hit_spans": arrow_span, "hit_runs": arrow_run}
                yield pa.RecordBatch.from_arrays([*batch.columns[:n], *(batch.column(n) if g == "hit_text" else pa.array(made[g], arrays[g]) for g in given)], names=[*keep, *given])

        out = out.mapInArrow(scan, schema)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, max_hit_share: float = 0.0, **options) -> DataFrame:
    """Documents, all columns, of whose words no larger share than ``max_hit_share`` is hit; documents without words stay.

    The row travels inside a struct beside its text, so its columns may have any names and nothing is joined back.
    """
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(options.pop("text_col", "text")).alias("text"))
    scored = decontaminate(packed, benchmark, keep=["row"], spans=False, **options)
    return scored.where(F.col("n_hit") <= F.col("n_words") * F.lit(max_hit_share)).select(*[F.col(f"row.`{c}`").alias(c) for c in names])
