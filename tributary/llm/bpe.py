"""Operator 6: BPE encoding and decoding with a minimal acyclic transducer lexicon.

The pieces of text between white space are counted over all documents; the
words of the ``LEXICON_PIECES`` most frequent pieces are encoded once by exact
merges and compiled into a minimal acyclic automaton (equal suffixes share
states).  Every arc carries how many words sort before it, so the sums along a
path number the words, and the number gives the ids.
The automaton is one file of integers in the shared folder; Spark hands it to
each executor, whose Python workers map it into memory together.  A batch's
distinct words walk through it side by side; words it doesn't hold are merged
exactly, the pair of lowest rank first, leftmost on ties.  Results never depend
on the lexicon, only speed does.

The vocabulary file (a ``tokenizers`` JSON with byte-level BPE and a word-end
suffix) is read on the driver from the path given.  Text is taken apart as that
file says: special tokens first, then NFC, white space to one blank, each
character to lower case, words by its pattern, bytes as printable characters.

Defined cases: a null or empty text has no ids and decodes to the empty text;
repeated rows get equal results; a very long word is merged in
``n log n``; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import io
import json
import re
import struct
import sys
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import add_columns, bounded, drop_staged, staged
from tributary.session import shared_dir

LEXICON_PIECES = 300_000
#: Distinct pieces a counting task holds before it hands on its counts.
COUNT_PIECES = 400_000
#: Pieces of text whose ids a Python worker keeps at hand, twice over.
MEMO_PIECES = 200_000
#: Ends a piece's ids among those of others.
MARK = b"\xff\xff\xff\xff"


@functools.cache
def _classes() -> tuple[str, str]:
    """Letters and numbers as regular expression ranges, from the Unicode tables."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    return tuple("".join(f"\\U{ord(m[0][0]):08x}-\\U{ord(m[0][-1]):08x}" for m in regex.finditer(rf"\p{{{kind}}}+", every))
                 for kind in "LN")


#: Unicode white space.
SPACE = "\t-\r \x85\xa0  -     　"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Symbols, merges and word rules of a vocabulary file; small enough to send to every worker."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or model["end_of_word_suffix"] is None:
            raise ValueError("not a vocabulary of lower-case words with a word-end suffix")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {(self.vocab[a], self.vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.merged = [self.vocab[a + b] for a, b in pairs]
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.tokens = [names.get(i, "") for i in range(max(names) + 1)]
        chars = byte_characters()
        self.inner = [self.vocab[c] for c in chars]
        self.last = [self.vocab[c + self.suffix] for c in chars]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def prepare(self) -> None:
        letters, numbers = _classes()
        rule = self.pattern.replace(r"[\p{L}]", f"[{letters}]").replace(r"[\p{N}]", f"[{numbers}]")
        rule = rule.replace(r"[^\s\p{L}\p{N}]", f"[^{SPACE}{letters}{numbers}]")
        self._word, self._word_or_end = re.compile(rule), re.compile(rule + "|\n")
        self._space = re.compile(f"[{SPACE}]+")
        self._odd = re.compile("[\x1c-\x1f]")         # white space to Python, but not to the word rule
        self._special = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")")

    def pieces(self, text: str) -> list[str]:
        """The text between white space."""
        if self._odd.search(text):
            return [p for p in self._space.split(text) if p]
        return text.split()

    def words(self, text: str) -> list[str]:
        """Normalised words of a text; special tokens stand for themselves."""
        parts = self._special.split(text) if "<|" in text else [text]
        return [w for p in parts for w in ([p] if p in self.special else self._words(p))]

    def _words(self, text: str) -> list[str]:
        """Words of a text without special tokens."""
        return self._word.findall(self._space.sub(" ", self._lower(text)))

    @staticmethod
    def _lower(text: str) -> str:
        if not text.isascii():
            # lower-casing goes by the character, so a sigma at a word's end stays a plain one
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def words_of(self, pieces: list[str]) -> list[str]:
        """The words of pieces without special tokens, a line feed after each piece's own."""
        return self._word_or_end.findall(self._lower("\n".join(pieces) + "\n")) if pieces else []

    def merge(self, word: str) -> list[int]:
        """The ids of one word by exact merging."""
        if word in self.special:
            return [self.special[word]]
        data = word.encode("utf-8", "replace")
        ids = [self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]
        return self._merge_short(ids) if len(ids) <= 48 else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        get, none = self.ranks.get, len(self.merged)
        ranks = list(map(get, zip(ids, ids[1:]), repeat(none)))
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            ids[i:i + 2] = [self.merged[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), none)
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        n, heap = len(ids), []
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (rank := self.ranks.get((ids[i], ids[j]))) is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[j]))
        for i in range(n - 1):
            offer(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = self.merged[rank], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for x in ids if x >= 0]

    def decode(self, ids: list[int]) -> str:
        """As a vocabulary without a decoder: the tokens, one blank between."""
        return " ".join(map(self.tokens.__getitem__, ids))


def compile_lexicon(words: list[bytes], ids: list[list[int]]) -> np.ndarray:
    """Sorted distinct words and their ids -> the automaton as one array of integers.

    Layout: counts (states, arcs, words, ids); arc keys ``state * 256 + byte`` in order;
    arc targets; arc outputs; final flags; offsets into the ids; ids.
    """
    arcs: list[dict[int, int]] = [{}]
    final = [False]
    register: dict[tuple, int] = {}
    free: list[int] = []
    path = [0]                                    # the states along the last word, not yet shared

    def share(upto: int, word: bytes) -> None:
        while len(path) - 1 > upto:
            state = path.pop()
            key = (final[state], tuple(arcs[state].items()))
            same = register.get(key)
            if same is None:
                register[key] = state
            else:
                arcs[path[-1]][word[len(path) - 1]] = same
                arcs[state], final[state] = {}, False
                free.append(state)

    last = b""
    for word in words:
        common = next((i for i, (a, b) in enumerate(zip(word, last)) if a != b), min(len(word), len(last)))
        share(common, last)
        for b in word[common:]:
            if free:
                state = free.pop()
            else:
                state = len(arcs)
                arcs.append({})
                final.append(False)
            arcs[path[-1]][b] = state
            path.append(state)
        final[path[-1]] = True
        last = word
    share(0, last)
    holds: dict[int, int] = {}                    # words that end at or below a state
    stack = [0]
    while stack:
        state = stack[-1]
        todo = [t for t in arcs[state].values() if t not in holds]
        if todo:
            stack.extend(todo)
        else:
            holds[state] = final[state] + sum(holds[t] for t in arcs[state].values())
            stack.pop()
    number = {state: i for i, state in enumerate(sorted(holds))}
    rows = []
    for state in number:
        ahead = int(final[state])
        for b, target in sorted(arcs[state].items()):
            rows.append((number[state] * 256 + b, number[target], ahead))
            ahead += holds[target]
    table = np.array(sorted(rows), np.int64).reshape(-1, 3)
    flags = np.array([final[s] for s in sorted(number, key=number.get)], np.int64)
    ends = np.cumsum([0, *map(len, ids)])
    flat = np.array([i for x in ids for i in x], np.int64)
    return np.concatenate([[len(flags), len(table), len(words), len(flat)], table[:, 0], table[:, 1], table[:, 2],
                           flags, ends, flat]).astype(np.int32)


class Lexicon:
    """The mapped automaton."""

    def __init__(self, data: np.ndarray):
        states, arcs, words, n = (int(x) for x in data[:4])
        cuts = np.cumsum([4, arcs, arcs, arcs, states, words + 1, n])
        self.keys, self.targets, self.outputs, self.final, self.ends, self.ids = (
            data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True))

    def bytes_of(self, numbers: np.ndarray) -> list[bytes]:
        """The ids of words by their numbers, as little-endian unsigned 32-bit integers."""
        flat = memoryview(np.ascontiguousarray(self.ids).view(np.uint8))
        return [bytes(flat[4 * a:4 * b]) for a, b in zip(self.ends[numbers].tolist(), self.ends[numbers + 1].tolist())]

    def numbers(self, words: list[str]) -> np.ndarray:
        """The number of each word (without line feeds), or -1 where it isn't in the lexicon."""
        n = len(words)
        flat = np.frombuffer(("\n".join(words) + "\n").encode("utf-8", "replace"), np.uint8)
        ends = np.flatnonzero(flat == 10)[:n]
        start = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)[:n]
        size = ends - start
        state, out = np.zeros(n, np.int64), np.zeros(n, np.int64)
        alive = np.flatnonzero(size > 0) if len(self.keys) else np.zeros(0, np.int64)
        result = np.full(n, -1, np.int64)
        step = 0
        while len(alive):
            key = state[alive] * 256 + flat[start[alive] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            alive, at = alive[hit], at[hit]
            state[alive] = self.targets[at]
            out[alive] += self.outputs[at]
            step += 1
            ended = size[alive] == step
            done = alive[ended]
            done = done[self.final[state[done]] > 0]
            result[done] = out[done]
            alive = alive[~ended]
        return result


class Encoder:
    """Encodes and decodes on one worker, with the mapped lexicon at hand.

    Words never cross white space, so the ids of each distinct piece between
    white space are worked out once and kept, in two generations.
    """

    def __init__(self, vocab: Vocabulary, lexicon: Lexicon | None):
        vocab.prepare()
        self.vocab, self.lexicon, self.memo, self.old = vocab, lexicon, {}, {}

    def learn(self, pieces: set[str]) -> None:
        """Put the ids of pieces into the memo: their words from the automaton, else by merging."""
        new = [p for p in pieces if p not in self.memo]
        if len(self.memo) + len(new) > MEMO_PIECES:
            self.old, self.memo, new = self.memo, {}, list(pieces)
        fresh = []
        for p in new:
            ids = self.old.get(p)
            if ids is None:
                fresh.append(p)
            else:
                self.memo[p] = ids
        odd = [p for p in fresh if "<|" in p]
        if odd:
            fresh = [p for p in fresh if "<|" not in p]
        flat = self.vocab.words_of(fresh)
        known = self.ids_of(list(set(flat).union(*map(self.vocab.words, odd)) - {"\n"}))
        for p in odd:
            self.memo[p] = b"".join(map(known.__getitem__, self.vocab.words(p)))
        # ids leave the upper bytes of each integer empty, so the mark can't appear among them
        known["\n"] = MARK
        self.memo.update(zip(fresh, b"".join(map(known.__getitem__, flat)).split(MARK)))

    def ids_of(self, words: list[str]) -> dict[str, bytes]:
        """The ids of each word: from the automaton, else by merging."""
        plain = [w for w in words if w not in self.vocab.special]
        known = {w: self._bytes(self.vocab.merge(w)) for w in words if w in self.vocab.special}
        at = self.lexicon.numbers(plain) if self.lexicon else np.full(len(plain), -1)
        held, rest = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        if len(held):
            known.update(zip([plain[i] for i in held.tolist()], self.lexicon.bytes_of(at[held]), strict=True))
        merge = self.vocab.merge
        for i in rest.tolist():
            known[plain[i]] = self._bytes(merge(plain[i]))
        return known

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids, as little-endian unsigned 32-bit integers."""
        split = [self.vocab.pieces(t) for t in texts]
        self.learn(set().union(*split))
        return [b"".join(map(self.memo.__getitem__, pieces)) for pieces in split]

    def decode(self, ids: bytes) -> str:
        return self.vocab.decode(np.frombuffer(ids, "<u4").tolist())


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """Where the installed vocabulary files lie on the driver."""
    import public_tokenizers
    return public_tokenizers.path(name)


def read_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        return Vocabulary(f.read())


def _texts(b: pd.DataFrame) -> list[str]:
    return [t if isinstance(t, str) else "" for t in b["text"]]


def frequent_words(docs: DataFrame, vocab, limit: int = LEXICON_PIECES) -> set[str]:
    """The words of the most frequent pieces over all documents, at most ``limit`` pieces.

    Pieces of text between white space are counted and only the frequent ones
    taken apart.  All pieces of a class of counts (16 classes to a doubling) are
    in or none, so the driver gets one row per class and then the pieces.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v, c = vocab.value, Counter()
        v.prepare()
        for b in batches:
            for t in _texts(b):
                c.update(v.pieces(t))
                if len(c) > COUNT_PIECES:
                    yield pd.DataFrame({"piece": list(c.keys()), "n": list(c.values())})
                    c.clear()
        if c:
            yield pd.DataFrame({"piece": list(c.keys()), "n": list(c.values())})

    counts = staged(docs.select("text").mapInPandas(count, "piece string, n long").groupBy("piece")
                    .agg(F.sum("n").alias("n")).where("n > 1")
                    .withColumn("class", F.floor(F.log2("n") * 16).cast("int")), "pieces")
    room, lowest = limit, None
    for r in counts.groupBy("class").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("class").desc()).collect():
        room -= r["n"]
        if room < 0:
            break
        lowest = r["class"]
    top = [] if lowest is None else [r["piece"] for r in counts.where(F.col("class") >= lowest).select("piece").collect()]
    drop_staged(counts)
    vocab.value.prepare()
    return {w for p in top if "<|" in p for w in vocab.value.words(p)} | set(
        vocab.value.words_of([p for p in top if "<|" not in p])) - {"\n"}


def share_file(spark, data: bytes) -> str:
    """Put a file in the shared folder and let every executor fetch it; returns its name there."""
    name = f"lexicon-{uuid.uuid4().hex}.npy"
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/llm-files/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(data))
    out.close()
    spark.sparkContext.addFile(path.toString())
    return name


def build(docs: DataFrame, vocab_path: str, lexicon_pieces: int = LEXICON_PIECES):
    """Broadcast vocabulary and the name of the lexicon file for ``docs``."""
    spark = bounded(docs)
    vocab = read_vocabulary(vocab_path)
    sent = spark.sparkContext.broadcast(vocab)
    words = frequent_words(docs, sent, lexicon_pieces)
    words = sorted({w.encode("utf-8", "replace") for w in words if w not in vocab.special})
    data = compile_lexicon(words, [vocab.merge(w.decode()) for w in words])
    buf = io.BytesIO()
    np.save(buf, data)
    return sent, share_file(spark, buf.getvalue())


def encode_documents(docs: DataFrame, vocab_path: str, lexicon_pieces: int = LEXICON_PIECES) -> DataFrame:
    """``(doc_id, ids, decoded)``: the ids of each text and what they decode to."""
    def rows(ids, decoded):
        return {"ids": [np.frombuffer(x, "<i4") for x in ids], "decoded": decoded}
    return _run(docs, vocab_path, lexicon_pieces, "ids array<int>, decoded string", rows)


def encode_digests(docs: DataFrame, vocab_path: str, lexicon_pieces: int = LEXICON_PIECES) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` for every document."""
    def rows(ids, decoded):
        return {"n_tokens": [len(x) // 4 for x in ids], "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                "decoded_sha256": [hashlib.sha256(x.encode("utf-8", "replace")).hexdigest() for x in decoded]}
    return _run(docs, vocab_path, lexicon_pieces, "n_tokens long, ids_sha256 string, decoded_sha256 string", rows)


def _run(docs: DataFrame, vocab_path: str, lexicon_pieces: int, new: str, rows) -> DataFrame:
    vocab, name = build(docs, vocab_path, lexicon_pieces)

    def make():
        enc = Encoder(vocab.value, Lexicon(np.load(SparkFiles.get(name), mmap_mode="r")))

        def encode(texts):
            ids = enc.encode([t or "" for t in texts])
            return rows(ids, [enc.decode(x) for x in ids])
        return encode

    return add_columns(docs, "text", new, make, ["doc_id"])
