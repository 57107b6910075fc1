"""Byte-level BPE encoding and decoding with a contiguous rank array per word.

The vocabulary is a ``tokenizers`` JSON file (byte-level BPE, no normaliser); its path is a parameter and the file is read
by each Python worker, never copied. A text is cut at added tokens, then at single spaces between words (whole text by
pattern where blanks meet other blanks), then by the pre-tokenising pattern. A word of at most ``SHORT_WORD`` bytes is
merged in a rank array: one entry for each boundary between two parts, holding the rank of merging them. The smallest
entry is found by a scan, its boundary is deleted, and the two neighbouring entries are refreshed. The words that a slice
of rows brings anew lie below each other as rows of one numpy array, so that each step serves all of them. Longer words
use a heap over a linked list, since the scan is quadratic.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import require, text_slices

#: Bytes up to which a word is merged in the rank array.
SHORT_WORD = 64
#: Words that a worker remembers before it forgets them all; bounds its memory whatever the vocabulary of the corpus.
CACHE_WORDS = 600_000
#: A pair that the vocabulary does not merge.
NEVER = 1 << 62

#: What the operator can return for a text.
OUTPUTS = {
    "token_ids": T.ArrayType(T.IntegerType(), False),
    "decoded": T.StringType(),
    "n_tokens": T.LongType(),
    "ids_sha256": T.StringType(),
    "decoded_sha256": T.StringType(),
}
_ARROW = {"token_ids": pa.list_(pa.int32()), "decoded": pa.string(), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies: printable Latin-1 stands for itself,
    the other bytes get the code points from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


# Code points (hexadecimal, ranges with a dash) that are letters or numbers only since Unicode 17; the
# tokenizers library knows Unicode 16, where they are other signs.
NEW_LETTERS = """558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959
10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11df1 16ea0-16eb8 16ebb-16ed3 16ff2-16ff3 187f8-187ff 18cd6-18cda 18d09-18d20
18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de
1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f"""
NEW_NUMBERS = "11de0-11de9 1246f 12475-1247f 12550-12686 16ff4-16ff6"

_ASCII_WORDS = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")


@lru_cache(maxsize=1)
def _unicode_words() -> regex.Pattern:
    def older(kind: str, newer: str) -> str:
        return f"[\\p{{{kind}}}--[{''.join('-'.join(f'\\U{int(x, 16):08x}' for x in r.split('-')) for r in newer.split())}]]"

    letter, number = older("L", NEW_LETTERS), older("N", NEW_NUMBERS)
    return regex.compile(f"(?V1)'(?:s|t|re|ve|m|ll|d)| ?{letter}+| ?{number}+| ?[^\\s{letter}{number}]+|\\s+(?!\\S)|\\s+")


def words_of(text: str) -> list[str]:
    """Cut a text as byte-level BPE does before it merges: contractions, then letters, numbers or other signs with a
    space before, then blanks."""
    return _ASCII_WORDS.findall(text) if text.isascii() else _unicode_words().findall(text)


#: A space that touches another blank: such a text is cut by the pattern as a whole.
_MIXED_BLANKS = re.compile("[\\s\x85] | [\\s\x85]")


class Vocabulary:
    """Merges, ids and bytes of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or spec.get("normalizer"):
            raise ValueError("only byte-level BPE without a normaliser is supported")
        to_byte = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.byte_id = [0] * 256
        for c, b in to_byte.items():
            self.byte_id[b] = vocab[c]
        self.pairs: dict[int, int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs.setdefault(vocab[left] << 32 | vocab[right], rank << 32 | vocab[left + right])
        keys = sorted(self.pairs)
        self.pair_keys = np.array(keys, np.int64)
        self.pair_values = np.array([self.pairs[k] for k in keys], np.int64)
        self.byte_ids = np.array(self.byte_id, np.int64)
        grid = self.byte_ids[:, None].repeat(256, axis=1)
        self.byte_pairs = self._ranks(grid, grid.T)
        self.bytes_of = {i: bytes(to_byte[c] for c in t) for t, i in vocab.items()}
        self.added: dict[str, int] = {}
        for t in spec.get("added_tokens") or []:
            if t["lstrip"] or t["rstrip"] or t["single_word"]:
                raise ValueError("added tokens that take blanks or whole words are not supported")
            self.added[t["content"]] = t["id"]
            self.bytes_of[t["id"]] = t["content"].encode()
        self.cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.text_of = {i: str(i) for i in self.bytes_of}
        self.bytes_of_text = {str(i): b for i, b in self.bytes_of.items()}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and merged id of pairs of ids; NEVER where there is no merge or an id is -1."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == keys) & (left >= 0) & (right >= 0), self.pair_values[at], NEVER)

    def merge_short(self, words: list[bytes]) -> list[list[int]]:
        """Ids of words of up to SHORT_WORD bytes; words of like length share an array."""
        out: list[list[int]] = [[]] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        at = 0
        while at < len(order):
            width = max(2, -(-len(words[order[at]]) // 4) * 4)
            rows = []
            while at < len(order) and len(words[order[at]]) <= width:
                rows.append(order[at])
                at += 1
            for i in range(0, len(rows), 4096):
                self._merge_rows(words, rows[i : i + 4096], width, out)
        return out

    def _merge_rows(self, words: list[bytes], rows: list[int], width: int, out: list[list[int]]) -> None:
        raw = np.frombuffer(b"".join([words[i].ljust(width, b"\0") for i in rows]), np.uint8).reshape(len(rows), width)
        size = np.array([len(words[i]) for i in rows])
        ids = np.where(np.arange(width) < size[:, None], self.byte_ids[raw], -1)
        ranks = np.where(np.arange(1, width) < size[:, None], self.byte_pairs[raw[:, :-1], raw[:, 1:]], NEVER)
        names, place, column = np.array(rows), np.arange(len(rows)), np.arange(width - 1)
        while True:
            best = ranks.argmin(axis=1)
            least = ranks[place, best]
            done = least == NEVER
            if done.any():
                for i, row in zip(names[done].tolist(), ids[done].tolist(), strict=True):
                    out[i] = row[: row.index(-1)] if row[-1] < 0 else row
                go = ~done
                names, ids, ranks, best, least = names[go], ids[go], ranks[go], best[go], least[go]
                place = np.arange(len(names))
                if not len(names):
                    return
            after = column >= best[:, None]
            ids[:, 1:-1] = np.where(after[:, 1:], ids[:, 2:], ids[:, 1:-1])
            ids[place, best] = least & 0xFFFFFFFF
            ids[:, -1] = -1
            ranks[:, :-1] = np.where(after[:, :-1], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = NEVER
            here = ids[place, best]
            ranks[place, best] = self._ranks(here, ids[place, np.minimum(best + 1, width - 1)])
            inner = best > 0
            ranks[place[inner], best[inner] - 1] = self._ranks(ids[place[inner], best[inner] - 1], here[inner])

    def merge_long(self, word: bytes) -> list[int]:
        """The same merges in n log n: a heap of (rank, place), stale entries skipped."""
        pairs = self.pairs
        ids = [self.byte_id[b] for b in word]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(v >> 32, i, v) for i in range(n - 1) if (v := pairs.get(ids[i] << 32 | ids[i + 1], NEVER)) != NEVER]
        heapq.heapify(heap)
        while heap:
            _, i, v = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or pairs.get(ids[i] << 32 | ids[j], NEVER) != v:
                continue
            ids[i], ids[j], after[i] = v & 0xFFFFFFFF, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (w := pairs.get(ids[left] << 32 | ids[right], NEVER)) != NEVER:
                    heapq.heappush(heap, (w >> 32, left, w))
        return [i for i in ids if i >= 0]

    def merge(self, word: bytes) -> list[int]:
        return self.merge_short([word])[0] if len(word) <= SHORT_WORD else self.merge_long(word)

    def decode_text(self, ids: Sequence[str]) -> str:
        """The text of ids given as decimals; bytes that are no UTF-8 become U+FFFD, unknown ids nothing."""
        get = self.bytes_of_text
        try:
            raw = b"".join([get[i] for i in ids])
        except KeyError:
            raw = b"".join([get.get(i, b"") for i in ids])
        return raw.decode("utf-8", errors="replace")

    def decode(self, ids: Sequence[int]) -> str:
        return self.decode_text([str(i) for i in ids])


class Encoder:
    """Encodes texts; ids come as comma-joined decimals, which is what is remembered for each word."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.known: dict[str, str] = {}

    def _learn(self, words: list[str]) -> None:
        """Encode pre-tokenised words that are not known yet, all at once."""
        raw = {w: w.encode() for w in words}
        short = [w for w, b in raw.items() if len(b) <= SHORT_WORD]
        text_of = self.vocabulary.text_of
        for w, ids in zip(short, self.vocabulary.merge_short([raw[w] for w in short]), strict=True):
            self.known[w] = ",".join([text_of[i] for i in ids])
        for w, b in raw.items():
            if len(b) > SHORT_WORD:
                self.known[w] = ",".join([text_of[i] for i in self.vocabulary.merge_long(b)])

    def _cut(self, text: str) -> list[str]:
        """Pieces of a text without added tokens that encode independently: the stretches between spaces (a space goes
        with what follows), or the words where blanks touch blanks."""
        if _MIXED_BLANKS.search(text):
            return words_of(text)
        head, *rest = text.split(" ")
        return [head, *[" " + x for x in rest]] if head else [" " + x for x in rest]

    def encode_texts(self, texts: Sequence[str]) -> list[str]:
        cut, added = self.vocabulary.cut, self.vocabulary.added
        plain: list[list[str]] = []  # of each text or part between added tokens
        plans: list[list[int]] = []  # of each text: the place in plain, or -1 - id of an added token
        for text in texts:
            plan: list[int] = []
            for part in cut.split(text) if cut and cut.search(text) else [text]:
                if part in added:
                    plan.append(-1 - added[part])
                elif part:
                    plan.append(len(plain))
                    plain.append(self._cut(part))
            plans.append(plan)
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known = self.known
        pieces = set().union(*plain).difference(known)
        words = {p: [p] if p[1:].isalpha() and (p[0] == " " or p[0].isalpha()) or p[0].isalpha() and len(p) == 1 else words_of(p) for p in pieces}
        self._learn(list({w for ws in words.values() for w in ws}.difference(known)))
        for p, ws in words.items():
            if len(ws) > 1:
                known[p] = ",".join([known[w] for w in ws])
        done = [",".join([known[p] for p in x]) for x in plain]
        return [",".join([done[k] if k >= 0 else str(-1 - k) for k in plan]) for plan in plans]

    def encode_text(self, text: str) -> str:
        return self.encode_texts([text])[0]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def bpe_round_trip(df: DataFrame, tokenizer_path: str, text_col: str = "text", keep: Sequence[str] = ("doc_id",), outputs: Sequence[str] = ("n_tokens", "token_ids", "decoded")) -> DataFrame:
    """Encode every whole text, then decode its ids.

    Returns the ``keep`` columns and the ``outputs``, any of :data:`OUTPUTS`; other columns are ignored whatever their
    names. Null and empty texts have no ids and decode to ''. Rows that repeat are encoded each. One pass without a
    shuffle; a worker holds a batch, the vocabulary and at most ``CACHE_WORDS`` words each with and without a space.
    """
    require(df, text_col, *keep)
    if unknown := [o for o in outputs if o not in OUTPUTS]:
        raise ValueError(f"unknown outputs: {', '.join(unknown)}")
    if clash := [k for k in keep if k in outputs]:
        raise ValueError(f"kept columns named as outputs: {', '.join(clash)}")
    keep, outputs = list(keep), list(outputs)
    schema = T.StructType([*(df.schema[k] for k in keep), *(T.StructField(o, OUTPUTS[o], True) for o in outputs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for batch in text_slices(batches):
            made: dict[str, list] = {o: [] for o in outputs}
            for joined in enc.encode_texts([text or "" for text in batch.column(len(keep)).to_pylist()]):
                ids = joined.split(",") if joined else []
                if "n_tokens" in made:
                    made["n_tokens"].append(len(ids))
                if "token_ids" in made:
                    made["token_ids"].append(list(map(int, ids)))
                if "ids_sha256" in made:
                    made["ids_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
                if "decoded" in made or "decoded_sha256" in made:
                    decoded = enc.vocabulary.decode_text(ids)
                    if "decoded" in made:
                        made["decoded"].append(decoded)
                    if "decoded_sha256" in made:
                        made["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *(pa.array(made[o], _ARROW[o]) for o in outputs)], names=[*keep, *outputs])

    return df.select(*keep, text_col).mapInArrow(run, schema)


def bpe_decode(df: DataFrame, tokenizer_path: str, ids_col: str = "token_ids", keep: Sequence[str] = ("doc_id",), output: str = "text") -> DataFrame:
    """The text of every list of ids; null lists give null, ids that the vocabulary lacks give nothing."""
    require(df, ids_col, *keep)
    keep = list(keep)
    schema = T.StructType([*(df.schema[k] for k in keep), T.StructField(output, T.StringType(), True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = encoder(tokenizer_path).vocabulary
        for batch in text_slices(batches):
            texts = [None if ids is None else vocabulary.decode([i for i in ids if i is not None]) for ids in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string())], names=[*keep, output])

    return df.select(*keep, ids_col).mapInArrow(run, schema)
