"""Helpers shared by the operators: shared-folder stages, text bytes, rolling hashes."""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from tributary.session import scratch_path

#: The words of a text: maximal runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Size of the batches that texts go to Python workers in.
ARROW_BYTES = 4 << 20
_ARROW_KEY, _ARROW_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20)
#: A task handles at most about so many text bytes at a time.
BATCH_BYTES = 2 << 20
#: Keys with at least 1 / HOT of all rows are joined by broadcast; there are at most HOT of them.
HOT = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table; Spark reads it, whatever store the path names."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded(df: DataFrame) -> SparkSession:
    """The session of ``df``, with Arrow batches of at most ``ARROW_BYTES`` unless it names its own size.

    Texts reach Python workers in such batches, so a worker's memory doesn't grow
    with the length of texts.
    """
    spark = df.sparkSession
    if spark.conf.get(_ARROW_KEY).rstrip("b") == _ARROW_DEFAULT:
        spark.conf.set(_ARROW_KEY, str(ARROW_BYTES))
    return spark


def staged(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` in the shared folder and read it back (``drop_staged`` removes it).

    A lost executor never recomputes past this point, and several readers share it.
    """
    path = scratch_path(df.sparkSession, f"llm-{kind}")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    _LIVE[path] = df.sparkSession
    return out


#: Paths that ``staged`` wrote and nothing has dropped, oldest first.
_LIVE: dict[str, SparkSession] = {}


def drop_staged(*frames: DataFrame) -> None:
    """Delete what ``staged`` wrote, once nothing reads it any more."""
    for df in frames:
        _drop(getattr(df, "_staged_path", None))


def live_copies() -> set[str]:
    """What ``staged`` wrote and nothing has dropped yet."""
    return set(_LIVE)


def drop_copies_since(before: set[str], *keep: DataFrame) -> None:
    """Delete the copies written since ``before``, but for those of ``keep``."""
    kept = {getattr(df, "_staged_path", None) for df in keep}
    for path in [p for p in _LIVE if p not in before and p not in kept]:
        _drop(path)


def _drop(path: str | None) -> None:
    spark = _LIVE.pop(path, None)
    if spark is not None:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def join_counted(left: DataFrame, right: DataFrame, key: list[str], n: str) -> DataFrame:
    """Inner join with ``right``, which has one row per ``key`` and in ``n`` its number of rows in ``left``.

    Nulls are equal.  Keys that hold at least 1 / HOT of the counted rows, at most HOT of
    them, are broadcast; without them no key of the shuffle join is large.  Both sides
    are read more than once, so stage what is dear to make.
    """
    total = right.agg(F.sum(n)).first()[0] or 0
    names = {k: f"_key{i}" for i, k in enumerate(key)}
    other = right.select(*[F.col(c).alias(names.get(c, c)) for c in right.columns if c != n], F.col(n).alias("_rows"))
    match = reduce(and_, [F.col(k).eqNullSafe(F.col(v)) for k, v in names.items()])
    hot, cold = other.where(F.col("_rows") * HOT >= total), other.where(F.col("_rows") * HOT < total)
    met = left.join(F.broadcast(hot), match)
    rest = left.join(F.broadcast(hot.select(*names.values())), match, "left_anti").join(cold, match)
    return met.unionByName(rest).drop("_rows", *names.values())


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True for rows kept from training: crc32 of the id's text, modulo ``modulus``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def encoded(texts) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]


def chunks(sizes, limit: int = BATCH_BYTES):
    """Slices of consecutive rows of at most ``limit`` bytes together (one row at least)."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def text_slices(batch: pd.DataFrame, limit: int = BATCH_BYTES):
    """Parts of a batch with ``text``, as (slice, encoded texts); only a part is held as bytes at a time."""
    texts = batch["text"].tolist()
    for part in chunks([len(t) if isinstance(t, str) else 0 for t in texts], limit):
        yield part, encoded(texts[part])


def add_columns(df: DataFrame, text: str, new: str, make, keep: list[str], more: list[str] = (),
                limit: int = BATCH_BYTES) -> DataFrame:
    """``keep`` columns of ``df``, unchanged, and new ones worked out from its texts in Arrow batches.

    ``make()`` runs once per task and gives a function of (texts, *``more`` columns as lists) to
    a dict of the columns that ``new`` declares.  At most ``limit`` text bytes (or one
    text) go at a time.  Columns of ``keep`` that ``new`` names are replaced.
    """
    bounded(df)
    fresh = StructType.fromDDL(new)
    keep = [c for c in keep if c not in fresh.names]
    own = df.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias("_text"), *[F.col(c).alias(f"_{c}") for c in more])
    kinds = {f.name: to_arrow_type(f.dataType) for f in fresh}
    n = len(keep)

    def run(batches):
        work = make()
        for b in batches:
            texts = b.column(n).to_pylist()
            for part in chunks([len(t) if t else 0 for t in texts], limit):
                rows = b.slice(part.start, part.stop - part.start)
                made = work(texts[part], *[rows.column(n + 1 + i).to_pylist() for i in range(len(more))])
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:n], *[pa.array(made[k], kind, from_pandas=True) for k, kind in kinds.items()]],
                    names=[*keep, *kinds])

    return own.mapInArrow(run, StructType([*own.schema.fields[:n], *fresh.fields]))


def shielded(docs: DataFrame) -> tuple[DataFrame, callable]:
    """``docs`` with every column under a private name beside its own columns, and the way back.

    Operators may then add columns of any name; the way back takes the private ones alone.
    """
    names = docs.columns
    hidden = docs.select(*[F.col(f"`{c}`").alias(f"_own{i}") for i, c in enumerate(names)],
                         *[F.col(f"`{c}`") for c in ("doc_id", "text", "lang", "source") if c in names])
    return hidden, lambda df: df.select(*[F.col(f"_own{i}").alias(c) for i, c in enumerate(names)])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def runs(batches, key: list[str]):
    """Whole groups of rows with equal ``key``, from batches in which they follow each other."""
    kept, last = [], None
    for b in batches:
        if not len(b):
            continue
        cuts = np.flatnonzero((b[key].to_numpy()[1:] != b[key].to_numpy()[:-1]).any(axis=1)) + 1
        for i, j in zip([0, *cuts], [*cuts, len(b)], strict=True):
            own = tuple(b[key].iloc[i])
            if kept and own != last:
                yield pd.concat(kept, ignore_index=True)
                kept = []
            kept.append(b.iloc[i:j])
            last = own
    if kept:
        yield pd.concat(kept, ignore_index=True)


def whole_groups(batches, key: list[str]):
    """Rows in batches that end where ``key`` changes, so groups of equal ``key`` stay together."""
    kept = []
    for b in batches:
        if not len(b):
            continue
        same = np.logical_and.reduce([b[c].to_numpy() == b[c].iloc[-1] for c in key])
        cut = len(b) - int(same.sum())                 # where the last group begins
        if cut or (kept and any(kept[-1][c].iloc[-1] != b[c].iloc[0] for c in key)):
            if not cut:
                yield pd.concat(kept, ignore_index=True)
            else:
                yield pd.concat([*kept, b.iloc[:cut]], ignore_index=True)
            kept = []
        kept.append(b.iloc[cut:])
    if kept:
        yield pd.concat(kept, ignore_index=True)


class Rolling:
    """Hashes of any substrings of a byte buffer, from one pass of prefix sums.

    The hash of ``[s, e)`` is the sum of ``T[byte] * B**i`` over the substring,
    shifted to offset 0, modulo 2**64, with random values ``T`` and odd ``B``.
    Equal strings have equal hashes; others collide with odds near 2**-64.
    """

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(0, 2**64, 256, dtype=np.uint64)
        self.base = np.uint64(int(rng.integers(0, 2**62)) * 4 + 1)
        self.inverse = np.uint64(pow(int(self.base), -1, 2**64))
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n + 1:
            for name, b in (("powers", self.base), ("inverses", self.inverse)):
                p = np.full(n + 1, b, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def prefix(self, buf: np.ndarray) -> np.ndarray:
        """``out[i]``: the sum over the first ``i`` bytes."""
        self._grow(len(buf) + 1)
        out = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(self.values[buf] * self.powers[: len(buf)], out=out[1:])
        return out

    def of(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((prefix[end] - prefix[start]) * self.inverses[start])

    def fixed(self, prefix: np.ndarray, k: int) -> np.ndarray:
        """Hash of the ``k`` bytes at every position that has as many."""
        n = max(0, len(prefix) - k)
        return mix((prefix[k:] - prefix[:n]) * self.inverses[:n])
