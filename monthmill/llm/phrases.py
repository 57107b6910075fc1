"""Phrase collocations, counted in a prefix-free parse of the corpus.

A text is a sequence of tokens: its words (A-Z lower-cased) and a mark between two pieces (``[.,;:!?\\x0A-\\x0D]`` ends one). It
is cut where its content says so: a place is a trigger when a hash of the ``OVERLAP`` tokens before it is divisible by
``PERIOD``. A chunk runs from ``OVERLAP`` tokens before one trigger to the next, so no chunk begins within another and equal
passages are cut alike, wherever they stand. The chunks, with how often each is parsed, are the dictionary, a written table;
from then on nothing reads a text again. A phrase of up to ``OVERLAP`` + 1 words that ends behind a chunk's overlap lies in it
whole and is counted there, once for each time that the chunk was parsed; one that ends within the overlap belongs to the chunk
before. What stretches beyond ``MOST_TOKENS`` without a trigger is cut all the same, which costs nothing but repetition.

The chunks are gone through three times: for words; for hashes of pairs of frequent words; and for phrases all of whose pairs are
frequent, as no phrase is more frequent than one within it. Which words and pairs are frequent is told to the tasks by a bitmap
of ``FILTER_BITS`` bits, whatever the corpus: a bit too many, or two pairs of one hash, let a phrase be counted that is rare,
and no frequent one is ever left out. What is returned was counted by whole strings, added up by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialise, require, text_slices

#: Words of the longest phrase; a chunk begins with so many tokens, less one, of the chunk before.
MOST_WORDS = 5
OVERLAP = MOST_WORDS - 1
#: One place in so many is a trigger; tokens of a chunk behind its overlap, at most.
PERIOD, MOST_TOKENS = 32, 4096
MIN_COUNT, TOP = 100, 2000
#: Shares into which a language's phrases are dealt before they are ranked.
SHARES = 64
#: Language of rows without one.
NO_LANG = "und"
#: Bits of the filters that tell tasks which words and pairs are frequent.
FILTER_BITS = 1 << 25
#: Bytes of chunks whose phrases are counted at once in a task.
SLICE_BYTES = 8_000_000
#: Bytes of texts that are parsed at once.
TEXT_BYTES = 2_000_000
#: The mark between two pieces, which no word holds, and that between two texts, which no UTF-8 has.
MARK, NEXT = 10, 0xFF
_BLANK, _END, _TEXT = 1, 2, 3
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = _END
_KIND[NEXT] = _TEXT
_AS_BYTE = np.array([0, 0x20, MARK, NEXT], np.uint8)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def normalised(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts with one blank between two of a piece, a mark between two pieces, and another between two texts
    that have words; and the numbers of these texts."""
    joined = np.frombuffer(b"\xff" + b"\xff".join(t.encode().lower() for t in texts) + b"\xff", np.uint8)  # A-Z alone are lowered
    kind = _KIND[joined]
    gap = kind > 0
    first = gap & np.r_[True, ~gap[:-1]]
    at = np.flatnonzero(first)
    # a gap is what its strongest character makes it; one may hold the marks of several texts, of which the last one goes on
    widest = np.maximum.reduceat(kind, at)
    out = joined.copy()
    out[at] = _AS_BYTE[widest]
    texts_so_far = np.cumsum(np.add.reduceat((kind == _TEXT).astype(np.int64), at))
    # the outermost gaps part no words
    return out[~gap | first][1:-1], texts_so_far[widest == _TEXT][:-1] - 1


def words_of(body: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words begin and end in a normalised text, and the number of each one's token, of which marks are some."""
    gap = np.flatnonzero((body == 0x20) | (body == MARK) | (body == NEXT))
    begin, end = np.r_[0, gap + 1], np.r_[gap, len(body)]
    token = np.r_[0, np.cumsum(1 + (body[gap] == MARK))]
    return begin, end, token


def encoded(body: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Numbers of the words among the distinct ones, and these."""
    offsets = np.r_[0, np.cumsum(end - begin)].astype(np.int64)
    held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(body[(body != 0x20) & (body != MARK) & (body != NEXT)])])
    coded = held.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def word_hashes(words: pa.Array, seed: int = 0) -> np.ndarray:
    """A hash of each word: the sum of hashes of its bytes with their places."""
    if not len(words):
        return np.zeros(0, np.uint64)
    _, ends, body = words.buffers()
    offsets = np.frombuffer(ends, np.int64)[words.offset : words.offset + len(words) + 1]
    raw = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64)
    begin = offsets[:-1] - offsets[0]
    place = np.arange(len(raw), dtype=np.int64) - np.repeat(begin, np.diff(offsets))
    with np.errstate(over="ignore"):
        return mixed(np.add.reduceat(mixed(raw | place.astype(np.uint64) << np.uint64(8)), begin) ^ np.uint64(seed))


def mixed(x: np.ndarray) -> np.ndarray:
    """A hash of longs all of whose bits depend on all of theirs."""
    x = (x ^ x >> np.uint64(32)) * _ODD[0]
    x = (x ^ x >> np.uint64(29)) * _ODD[1]
    return x ^ x >> np.uint64(32)


def cuts(hashes: np.ndarray, text: np.ndarray, period: int = PERIOD, most: int = MOST_TOKENS) -> np.ndarray:
    """Tokens with which chunks begin their own part: a text's first, those at triggers, and what keeps a part from growing over
    ``most``. text: the text that each token is of."""
    n = len(hashes)
    m = max(0, n - OVERLAP)
    with np.errstate(over="ignore"):
        rolled = sum((hashes[k : k + m] * _ODD[k % 4] ^ hashes[k : k + m] >> np.uint64(7 + k) for k in range(OVERLAP)), np.zeros(m, np.uint64))
    hit = (mixed(rolled) % np.uint64(period) == 0) & (text[:m] == text[OVERLAP:])
    start = np.r_[True, text[1:] != text[:-1]]
    start[OVERLAP:] |= hit
    at = np.flatnonzero(start)
    wide = np.flatnonzero(np.diff(np.r_[at, n]) > most)
    more = [np.arange(at[i] + most, n if i + 1 == len(at) else at[i + 1], most) for i in wide]
    return np.unique(np.concatenate([at, *more])) if more else at


def parse(texts: Sequence[str], period: int = PERIOD, most: int = MOST_TOKENS) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The chunks of texts: the text that each is of, whether it begins the text, and its tokens, of which the first OVERLAP
    belong to the chunk before if not."""
    body, numbers = normalised(texts)
    if not len(body):
        return np.zeros(0, np.int64), np.zeros(0, bool), []
    begin, end, token = words_of(body)
    coded, distinct = encoded(body, begin, end)
    n = int(token[-1]) + 1
    hashes = np.full(n, _ODD[3], np.uint64)  # a mark's, where no word stands
    hashes[token] = word_hashes(distinct)[coded]
    of_word = np.r_[0, np.cumsum(body[end[:-1]] == NEXT)]
    starts, text = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    starts[token], text[token] = begin, of_word
    marks = np.flatnonzero(starts < 0)  # a mark stands right before a word of its text
    starts[marks], text[marks] = starts[marks + 1] - 1, text[marks + 1]
    at = cuts(hashes, text, period, most)
    own = text[at]
    leads = np.r_[True, own[1:] != own[:-1]]
    first = starts[np.where(leads, at, at - OVERLAP)]
    last = np.r_[starts[at[1:]] - leads[1:], len(body)]
    raw = body.tobytes()
    return numbers[own], leads, [raw[a:b].rstrip(b" ") for a, b in zip(first.tolist(), last.tolist(), strict=True)]


def dictionary(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", period: int = PERIOD, most: int = MOST_TOKENS) -> DataFrame:
    """Chunks of all texts with how often each is parsed: lang, first (it begins a text), chunk, n."""

    def parsed(texts: list[str], langs: list[str]) -> pa.RecordBatch:
        of, first, chunks = parse(texts, period, most)
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()).take(pa.array(of)), pa.array(first), pa.array(chunks, pa.binary())], names=["lang", "first", "chunk"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts, langs, size = [], [], 0
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                texts.append(text)
                langs.append(lang)
                size += len(text)
                if size >= TEXT_BYTES:
                    yield parsed(texts, langs)
                    texts, langs, size = [], [], 0
            if texts:
                yield parsed(texts, langs)

    rows = docs.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), F.coalesce(F.col(f"`{lang_col}`"), F.lit(NO_LANG)).alias("lang"))
    return rows.mapInArrow(run, "lang string, first boolean, chunk binary").groupBy("lang", "first", "chunk").agg(F.count("*").alias("n"))


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[tuple[str, list[bytes], np.ndarray, np.ndarray]]:
    """Chunks of one language, about so many bytes of all languages at a time: lang, chunks, whether each begins a text, parses."""
    held: dict[str, list[tuple]] = {}
    size = 0

    def flush():
        for lang, rows in held.items():
            chunks, first, n = zip(*rows, strict=True)
            yield lang, list(chunks), np.array(first, bool), np.array(n, np.int64)
        held.clear()

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("lang", "chunk", "first", "n")), strict=True):
            held.setdefault(row[0], []).append(row[1:])
            size += len(row[1])
            if size >= limit:
                yield from flush()
                size = 0
    yield from flush()


def places(chunks: list[bytes], first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The words of chunks laid end to end: number of each, the distinct words, the piece it stands in, whether a phrase that
    ends there is the chunk's own, and how often it counts."""
    # two marks stand between chunks, so that none is mistaken for a piece that goes on
    body = np.frombuffer(b"\n".join(c.strip(b"\n") for c in chunks), np.uint8)
    begin, end, _ = words_of(body)
    numbers, distinct = encoded(body, begin, end)
    piece = np.r_[0, np.cumsum(body[end[:-1]] == MARK)]
    # a chunk's tokens are told from the chunk itself, whose first may be a mark
    size = np.array([len(c.strip(b"\n")) + 1 for c in chunks], np.int64)
    chunk = np.searchsorted(np.cumsum(size), begin, "right")
    head = np.searchsorted(chunk, np.arange(len(chunks)))
    token = np.r_[0, np.cumsum(1 + (body[end[:-1]] == MARK))]
    led = np.array([c[:1] == b"\n" for c in chunks])
    own = first[chunk] | (token - token[head[chunk]] + led[chunk] >= OVERLAP)
    return numbers, distinct, piece, own, n[chunk]


def bit_of(hashes: np.ndarray, bits: int | None = None) -> np.ndarray:
    return (mixed(hashes) % np.uint64(bits or FILTER_BITS)).astype(np.int64)


def has_bit(packed: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return packed[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1 == 1


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return a * _ODD[1] + (b ^ b >> np.uint64(31)) * _ODD[2]


def lang_seed(lang: str) -> int:
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(lang.encode())


def frequent_pairs(chunks: DataFrame, words: np.ndarray, min_count: int) -> DataFrame:
    """Hashes of the pairs of frequent words that occur ``min_count`` times or more, one column h; equal hashes count as one."""
    sent = chunks.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, bodies, first, parses in slices(batches):
            numbers, distinct, piece, own, weight = places(bodies, first, parses)
            h = word_hashes(distinct, lang_seed(lang))
            good = has_bit(sent.value, bit_of(h))[numbers]
            at = np.flatnonzero(good[:-1] & good[1:] & (piece[:-1] == piece[1:]) & own[1:])
            code, inverse = np.unique(numbers[at] * len(h) + numbers[at + 1], return_inverse=True)
            f = np.bincount(inverse, weights=weight[at + 1], minlength=len(code)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pair_hash(h[code // len(h)], h[code % len(h)]).view(np.int64)), pa.array(f)], names=["h", "f"])

    return chunks.mapInArrow(run, "h bigint, f bigint").groupBy("h").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count).select("h")


def gram_counts(chunks: DataFrame, lengths: range, pairs: np.ndarray | None = None) -> DataFrame:
    """Phrases of these lengths with their counts: lang, phrase, words, f. ``pairs``: bits of the pairs that are frequent; a
    longer phrase is only looked at where all its pairs have theirs."""
    sent = chunks.sparkSession.sparkContext.broadcast(pairs) if pairs is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, bodies, first, parses in slices(batches):
            numbers, distinct, piece, own, weight = places(bodies, first, parses)
            words = distinct.cast(pa.large_string())
            if 1 in lengths:
                yield emitted(lang, 1, words, np.arange(len(words))[:, None], np.bincount(numbers[own], weights=weight[own], minlength=len(words)))
            if lengths.stop <= 2:
                continue
            live = piece[:-1] == piece[1:]
            if sent is not None:
                hashes = word_hashes(distinct, lang_seed(lang))[numbers]
                at = np.flatnonzero(live)
                live[at] = has_bit(sent.value, bit_of(pair_hash(hashes[at], hashes[at + 1])))
            # phrases as (number of the one a word shorter, last word), numbered anew at each length
            parts = np.flatnonzero(live)
            code = numbers[parts] * len(words) + numbers[parts + 1]
            for k in range(2, lengths.stop):
                if k > 2:
                    kept = (parts + k - 1 < len(numbers)) & live[np.minimum(parts + k - 2, len(live) - 1)]
                    parts, code = parts[kept], inverse[kept] * len(words) + numbers[parts[kept] + k - 1]
                if not len(parts):
                    break
                _, place, inverse = np.unique(code, return_index=True, return_inverse=True)
                if k in lengths:
                    mine = own[parts + k - 1]
                    f = np.bincount(inverse[mine], weights=weight[parts[mine] + k - 1], minlength=len(place))
                    yield emitted(lang, k, words, numbers[parts[place][:, None] + np.arange(k)], f)

    rows = chunks.mapInArrow(run, "lang string, phrase string, words int, f bigint")
    return rows.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))


def emitted(lang: str, k: int, words: pa.Array, numbers: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
    seen = f > 0
    numbers, f = numbers[seen], f[seen].astype(np.int64)
    parts = [words.take(pa.array(numbers[:, i])) for i in range(k)]
    phrase = parts[0] if k == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))
    n = len(f)
    return pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), phrase.cast(pa.string()), pa.array(np.full(n, k, np.int32)), pa.array(f)], names=["lang", "phrase", "words", "f"])


def bitmap(hashes: DataFrame) -> np.ndarray:
    """The bits of a column of hashes, packed; made of the distinct bits, which are FILTER_BITS at most."""
    bits = FILTER_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(bit_of(batch.column(0).to_numpy().view(np.uint64), bits)).astype(np.int32))], names=["bit"])

    out = np.zeros(-(-bits // 8), np.uint8)
    told = hashes.mapInArrow(run, "bit int").distinct().toArrow().column("bit").to_numpy()
    np.bitwise_or.at(out, told >> 3, (128 >> (told & 7)).astype(np.uint8))
    return out


def hashed_words(words: DataFrame) -> DataFrame:
    """The hash of each word of its language, as :func:`frequent_pairs` has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds = {lang: lang_seed(lang) for lang in batch.column(0).unique().to_pylist()}
            for lang, seed in seeds.items():
                own = batch.column(1).filter(pc.equal(batch.column(0), lang))
                yield pa.RecordBatch.from_arrays([pa.array(word_hashes(own.cast(pa.large_binary()), seed).view(np.int64))], names=["h"])

    return words.select("lang", "phrase").mapInArrow(run, "h bigint")


def exact_score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (l r)) in decimals of 38 digits."""
    wide = lambda c: c.cast("decimal(19,0)")
    # a is no larger than r, so 1000 a n over l r stays within 64 bits though the products may not
    top = (wide(a) * wide(n)).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")
    return F.call_function("div", top.cast("decimal(38,0)"), (wide(left) * wide(right)).cast("decimal(38,0)"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, top: int = TOP, period: int = PERIOD, most: int = MOST_TOKENS) -> DataFrame:
    """The first ``top`` phrases of each language by score: lang, rank, phrase, a, l, r, n, score.

    A phrase has 2 to 5 words of one piece and occurs ``min_count`` times or more, overlaps included; its score is that of its
    lowest-scoring cut in two. A phrase within a longer one that occurs as often is dropped. Null texts are empty, a null
    language is 'und'; each row counts, also where rows repeat; other columns are ignored, whatever their names. Words of any
    length are kept whole. No text, no phrase: an empty table gives an empty one.
    """
    require(docs, text_col, lang_col)
    if min_count < 1 or period < 1 or most < OVERLAP:
        raise ValueError(f"min_count and period must be at least 1, most {OVERLAP}")
    chunks, chunks_path = materialise(dictionary(docs, text_col, lang_col, period, most), "phrase-chunks")
    enough = F.col("f") >= min_count
    words, _ = materialise(gram_counts(chunks, range(1, 2)), "phrase-words")
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    # written, as the shuffle files of a written table go with it
    often, often_path = materialise(frequent_pairs(chunks, bitmap(hashed_words(words.where(enough))), min_count), "phrase-pairs")
    pairs = bitmap(often)
    discard(chunks.sparkSession, often_path)
    found, _ = materialise(gram_counts(chunks, range(2, MOST_WORDS + 1), pairs).where(enough), "phrase-counts")
    discard(chunks.sparkSession, chunks_path)
    known = words.where(enough).unionByName(found).select("lang", "phrase", "f")

    tokens = F.split("phrase", " ")
    part = lambda at, size: F.array_join(F.slice("w", at, size), " ")
    cut = found.select("lang", "phrase", F.col("f").alias("a"), tokens.alias("w"), F.explode(F.sequence(F.lit(1), F.size(tokens) - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.size("w") - F.col("k")).alias("rest"))
    cut = cut.join(known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"]).join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]).join(total, "lang")
    cut = cut.select("lang", "phrase", "a", "n", F.struct(exact_score(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r").alias("cut"))
    scored = cut.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"), F.min("cut").alias("cut"))

    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size(tokens) - 1), lambda k: F.transform(F.sequence(F.lit(1), F.size(tokens) - k + 1), lambda i: F.array_join(F.slice(tokens, i, k), " "))))
    within = found.where("words > 2").select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = scored.join(within, ["lang", "phrase"], "left").where(F.coalesce(F.col("longer") < F.col("a"), F.lit(True)))
    # the first of each share of a language's phrases, before what is left of the shares meets
    by = lambda *keys: F.row_number().over(Window.partitionBy("lang", *keys).orderBy(F.desc("cut.score"), F.desc("a"), "phrase"))
    best = kept.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES))).withColumn("rank", by("share")).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", by()).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
