"""Removal of byte strings that an earlier document holds too, by refining the order of their shards' suffixes.

Every 50-byte string has a minimizer (the 20-byte string in it with the smallest hash), the
same wherever the string stands. Texts are cut into pieces, runs of neighbouring strings
with one minimizer, so all places of a string are found among the pieces of its minimizer.

1. A minimizer that only one text holds ends there; most do.
2. Pieces of the others are read, and equal pieces become one with the smallest id.
3. Where a minimizer has several different pieces, these are the shards of a bucket, and their suffixes are
   brought into one order by rounds of interleave refinement: each puts two symbols before every suffix and moves the
   suffixes stably by these, so after ``length / 2`` rounds they stand by ``length`` bytes and no suffix was ever
   compared. Borders between blocks are carried along: a block is an interval of suffixes with a common prefix, and only
   intervals of several suffixes are refined further. No transform of a single shard is built before: rounds start
   from text order, since a match needs no order beyond ``length`` bytes. It is a radix sort of that depth.
4. What an earlier document holds is marked and cut out.

Shards are bounded: buckets are dealt by the minimizer's hash, their number grows with the
pieces, and a minimizer with very many pieces is dealt by single strings and their contents
instead. Frequent minimizers, known from a bounded sample, pass step 1 without meeting in a
task; which those are changes no result.

* NULL text counts as empty. Texts under ``length`` bytes lose nothing.
* NULL ids come after all others, and rows with equal ids take nothing from each other.
* Equal texts are looked at once; copies with a larger id than the first are removed whole.
* Very long texts are scanned in slices; nothing is cut off.
* Extra columns are left out by ``repeated`` and kept by ``without_repeats``, whatever their
  names; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwell.llm.common import collected, discard, groups_for, staged, text_or_empty

LENGTH, MINIMIZER = 50, 20
#: Different pieces of a bucket, about; pieces of a minimizer from which it is dealt by strings.
PER_BUCKET, HOT_PIECES = 20_000, 5_000
#: Documents of the sample that names frequent minimizers; documents of it that one must be in.
SAMPLE, FREQUENT = 4_000, 8
_SLICE = 1 << 20
#: Bytes of a piece at most; a longer run of one minimizer is several pieces.
_LONGEST = 16_384
_LAST = 2 ** 63 - 1


def _window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A mixed 64-bit hash of each ``width`` bytes, from hashes of power-of-two blocks."""
    count = len(data) - width + 1
    block, size, factor, done, total = data.astype(np.uint64), 1, 0x100000001B3, 0, None
    while size <= width:
        if width & size:
            part = block[done:done + count]
            total = part.copy() if total is None else total * np.uint64(factor) + part
            done += size
        if size * 2 > width:
            break
        block = block[:-size] * np.uint64(factor) + block[size:]
        factor, size = factor * factor % 2 ** 64, size * 2
    total = (total ^ (total >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    total = (total ^ (total >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return total ^ (total >> np.uint64(32))


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:len(values) - (width - size)], values[width - size:]) if size < width else values


def pieces(data: np.ndarray, ends: np.ndarray, length: int, minimizer: int):
    """text number, start, size and minimizer hash of the pieces of texts that lie one after
    the other in ``data``, text k in ``ends[k]`` to ``ends[k + 1]``."""
    for first in range(0, len(data) - length + 1, _SLICE):
        last = min(first + _SLICE, len(data) - length + 1)
        low = _smallest(_window_hashes(data[first:last + length - 1], minimizer), length - minimizer + 1)
        at = np.arange(first, last)
        text = np.searchsorted(ends, at, side="right") - 1
        whole = at + length <= ends[text + 1]
        new = np.ones(len(at), bool)
        new[1:] = (low[1:] != low[:-1]) | (text[1:] != text[:-1])
        starts = np.flatnonzero(whole & (new | ~np.r_[False, whole[:-1]]))
        stops = np.flatnonzero(whole & np.r_[new[1:] | ~whole[1:], True])
        number, begin, windows = text[starts], at[starts] - ends[text[starts]], stops - starts + 1
        low = low[starts]
        if len(windows) and windows.max() > _LONGEST - length:
            parts = -(-windows // (_LONGEST - length))
            k = np.arange(parts.sum()) - np.repeat(np.r_[0, parts.cumsum()[:-1]], parts)
            number, low, whole_run = np.repeat(number, parts), np.repeat(low, parts), np.repeat(windows, parts)
            begin = np.repeat(begin, parts) + k * (_LONGEST - length)
            windows = np.minimum(whole_run - k * (_LONGEST - length), _LONGEST - length)
        yield number, begin, windows - 1 + length, low.view(np.int64)


def _scan(docs: DataFrame, length: int, minimizer: int, frequent: np.ndarray) -> DataFrame:
    """deal, text_key and place of every piece. ``deal`` is what pieces are brought together by:
    the minimizer's hash, but for frequent minimizers anything that spreads them. ``place`` has
    start (31 bits), size (15) and the number of the frequent minimizer or 0 (18): a row for
    each piece is most of what this operator shuffles, so it is kept small."""
    known = docs.sparkSession.sparkContext.broadcast(frequent)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, key = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            raw = pa.compute.cast(text, pa.large_binary())
            ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
            if not len(raw) or raw.buffers()[2] is None:
                continue
            data = np.frombuffer(raw.buffers()[2], np.uint8)[ends[0]:ends[-1]]
            for number, at, size, low in pieces(data, ends - ends[0], length, minimizer):
                which = np.zeros(len(low), np.int64)
                if len(known.value):
                    near = np.minimum(np.searchsorted(known.value, low), len(known.value) - 1)
                    which = np.where(known.value[near] == low, near + 1, 0)
                deal = np.where(which > 0, (key[number] ^ at) * np.int64(0x9E3779B1), low)
                place = (at.astype(np.int64) << 33) | (size.astype(np.int64) << 18) | which
                yield pa.RecordBatch.from_arrays([pa.array(deal), pa.array(key[number]), pa.array(place)],
                                                 ["deal", "text_key", "place"])

    return docs.select(text_or_empty().alias("text")).withColumn("text_key", F.xxhash64("text")).mapInArrow(
        scan, "deal long, text_key long, place long")


def _frequent(docs: DataFrame, rows: int, length: int, minimizer: int) -> np.ndarray:
    """Minimizers of several texts that are frequent in a bounded sample."""
    sample = docs.sample(fraction=min(1.0, SAMPLE / max(1, rows)), seed=7)
    found = _scan(sample, length, minimizer, np.empty(0, np.int64)).groupBy(F.col("deal").alias("hash")).agg(
        F.count("*").alias("n"), (F.min("text_key") < F.max("text_key")).alias("several"))
    found = found.where(F.col("several") & (F.col("n") >= FREQUENT)).orderBy(F.desc("n"), "hash").limit(100_000)
    return np.sort(np.array([r["hash"] for r in found.select("hash").collect()], np.int64))


def earliest(parts: list[bytes], ids: np.ndarray, length: int) -> list[np.ndarray]:
    """For each shard and each string start in it, the smallest id of a shard with that string.

    Strings stand in the order of what follows a point in them, which starts at their ends and is moved to
    their starts. Each round puts two symbols before it and moves the strings stably by these, so they are
    sorted by what the point has passed, and blocks of equal strings lie together. A string that stands alone in its
    block does so however far it is extended, and takes part no longer: what is refined are repeated intervals only."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    starts, windows = np.r_[0, sizes.cumsum()], sizes - length + 1
    ends = np.r_[0, windows.cumsum()]
    shard = np.repeat(np.arange(len(parts)), windows)
    symbols = data.astype(np.uint16) * np.uint16(256) + np.roll(data, -1)
    kind = np.int32 if len(data) < 2 ** 31 else np.int64
    order = np.arange(ends[-1], dtype=kind)
    point = (starts[shard] - ends[shard] + np.arange(ends[-1]) + length).astype(kind)
    block = np.zeros(len(order), kind)
    for step in [2] * (length // 2) + [1] * (length % 2):
        if not len(order):
            break
        point -= step
        code = symbols[point] if step == 2 else data[point]
        by = code.argsort(kind="stable")
        order, point, code, block = order[by], point[by], code[by], block[by]
        new = np.ones(len(order) + 1, bool)
        np.logical_or(code[1:] != code[:-1], block[1:] != block[:-1], out=new[1:-1])
        several = ~(new[:-1] & new[1:])
        order, point = order[several], point[several]
        block = new[:-1][several].cumsum(dtype=kind)
    of = ids[shard]
    if len(order):
        first = np.flatnonzero(np.diff(block, prepend=0))
        of[order] = np.repeat(np.minimum.reduceat(of[order], first), np.diff(np.r_[first, len(order)]))
    return [of[x:y] for x, y in zip(ends, ends[1:])]


def _runs(flags: np.ndarray) -> tuple[list[int], list[int]]:
    edges = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    return edges[::2].tolist(), edges[1::2].tolist()


def spans(docs: DataFrame, length: int = LENGTH, minimizer: int = MINIMIZER) -> DataFrame:
    """text_key, first_id, starts, ends: the byte spans that the first document of each text
    loses, by text; texts that lose nothing are left out."""
    spark = docs.sparkSession
    order_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    texts = docs.select(order_id.alias("id"), text_or_empty().alias("text")).withColumn("text_key", F.xxhash64("text"))
    firsts = staged(texts.groupBy("text_key").agg(F.min("id").alias("first_id"), F.count("*").alias("copies")), "repeat-texts")
    rows = firsts.agg(F.sum("copies")).first()[0] or 0

    frequent = _frequent(docs, rows, length, minimizer)
    found = _scan(docs, length, minimizer, frequent)
    deal = Window.partitionBy("deal")
    several = found.withColumn("several", (F.col("place").bitwiseAND(0x3FFFF) != 0) | (
        F.min("text_key").over(deal) < F.max("text_key").over(deal)))
    lists = staged(several.where("several").groupBy("text_key").agg(F.collect_set(F.struct("place", "deal")).alias("cuts")).select(
        "text_key", "cuts.place", "cuts.deal").join(firsts.select("text_key", "first_id"), "text_key"), "repeat-lists")
    del found, several
    collected(spark)
    known = spark.sparkContext.broadcast(frequent)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            each = batch["place"].map(len).to_numpy()
            place, low = (np.concatenate(batch[c].to_list()) for c in ("place", "deal"))
            at, size, which = (place.view(np.uint64) >> np.uint64(33)).astype(np.int32), (place >> 18 & 0x7FFF).astype(np.int32), place & 0x3FFFF
            if len(known.value):
                low = np.where(which > 0, known.value[np.maximum(which - 1, 0)], low)
            raws = [t.encode() for t in batch["text"]]
            found = [raws[k][a:a + n] for k, a, n in zip(np.repeat(np.arange(len(raws)), each).tolist(), at.tolist(), size.tolist())]
            yield pd.DataFrame({"hash": low, "text_key": np.repeat(batch["text_key"].to_numpy(), each),
                                "first_id": np.repeat(batch["first_id"].to_numpy(), each), "at": at, "size": size,
                                "piece": pd.Series(found, dtype=object)})

    schema = "hash long, text_key long, first_id long, at int, size int, piece binary"
    joined = lists.hint("merge").join(texts.select(F.col("text_key").alias("key"), "id", "text"),
                                      (F.col("text_key") == F.col("key")) & (F.col("first_id") == F.col("id")))
    places = staged(joined.select("text", "text_key", "first_id", "place", "deal").mapInPandas(read, schema).withColumn(
        "piece_key", F.xxhash64("piece")), "repeat-places")
    del joined
    discard(lists)
    collected(spark)

    different = staged(places.groupBy("hash", "piece").agg(F.min("first_id").alias("earliest")).withColumn(
        "piece_key", F.xxhash64("piece")), "repeat-pieces")
    collected(spark)
    variety = different.groupBy("hash").agg(F.count("*").alias("pieces")).where("pieces > 1")
    shards = different.join(variety, "hash")
    total = variety.agg(F.sum("pieces")).first()[0] or 0
    buckets = groups_for(total, PER_BUCKET)
    single = F.explode(F.transform(F.sequence(F.lit(1), F.octet_length("piece") - (length - 1)),
                                   lambda k: F.struct((k - 1).alias("skip"), F.substring(F.col("piece"), k, F.lit(length)).alias("part"))))
    cool = shards.where(F.col("pieces") <= HOT_PIECES).select(
        F.pmod(F.xxhash64("hash"), F.lit(buckets)).alias("bucket"), "hash", "piece_key", "earliest", F.lit(0).alias("skip"),
        F.col("piece").alias("part"))
    hot = shards.where(F.col("pieces") > HOT_PIECES).select("hash", "piece_key", "earliest", single.alias("s")).select(
        F.pmod(F.xxhash64("hash", "s.part"), F.lit(buckets)).alias("bucket"), "hash", "piece_key", "earliest", "s.skip", "s.part")

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["hash", "piece_key", "skip"])
        ids = frame["earliest"].to_numpy()
        found = earliest(frame["part"].tolist(), ids, length)
        out = [(h, k, s + a, s + b) for h, k, s, own, smallest in zip(frame["hash"], frame["piece_key"], frame["skip"], ids, found)
               for a, b in zip(*_runs(smallest < own))]
        return pd.DataFrame(out, columns=["hash", "piece_key", "a", "b"])

    held = cool.unionByName(hot).groupBy("bucket").applyInPandas(merge, "hash long, piece_key long, a int, b int")
    held = held.groupBy("hash", "piece_key").agg(F.collect_list(F.struct("a", "b")).alias("runs"))
    pieces_held = staged(different.select("hash", "piece_key", "earliest").join(held, ["hash", "piece_key"], "left"), "repeat-held")

    # a later place of a piece goes whole; the first place loses what another piece had before
    at = F.col("at")
    whole = F.array(F.struct(at.alias("a"), (at + F.col("size")).alias("b")))
    parts = F.transform("runs", lambda r: F.struct((at + r["a"]).alias("a"), (at + r["b"] + (length - 1)).alias("b")))
    marked = places.select("hash", "piece_key", "text_key", "first_id", "at", "size").join(pieces_held, ["hash", "piece_key"]).select(
        "text_key", "first_id", F.when(F.col("first_id") > F.col("earliest"), whole).otherwise(parts).alias("runs"))
    found = staged(marked.where("runs is not null").groupBy("text_key", "first_id").agg(
        F.flatten(F.collect_list("runs")).alias("runs")).select(
        "text_key", "first_id", F.col("runs.a").alias("starts"), F.col("runs.b").alias("ends")), "repeat-spans")
    discard(firsts, places, different, pieces_held)
    return found


def _joined(starts, ends, size: int, everything: bool, length: int) -> list[tuple[int, int]]:
    """Maximal spans from overlapping ones."""
    if everything:
        return [(0, size)] if size >= length else []
    if starts is None or not len(starts):
        return []
    out: list[list[int]] = []
    for a, b in sorted(zip(np.asarray(starts).tolist(), np.asarray(ends).tolist())):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _kept(raw: bytes, cuts: list[tuple[int, int]]) -> bytes:
    edges = [0, *(e for c in cuts for e in c), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _with_spans(docs: DataFrame, length: int, minimizer: int) -> DataFrame:
    """``docs`` with __starts, __ends and __copy (whether an earlier row has the whole text)."""
    found = spans(docs, length, minimizer)
    collected(docs.sparkSession)
    order_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    keys = docs.select(order_id.alias("id"), F.xxhash64(text_or_empty()).alias("__key")).groupBy("__key").agg(
        F.min("id").alias("__first"))
    about = staged(keys.join(found.select(F.col("text_key").alias("__key"), F.col("starts").alias("__starts"),
                                          F.col("ends").alias("__ends")), "__key", "left"), "repeat-about")
    return docs.withColumn("__key", F.xxhash64(text_or_empty())).join(about.hint("merge"), "__key").withColumn(
        "__copy", order_id > F.col("__first")).drop("__key", "__first")


def repeated(docs: DataFrame, length: int = LENGTH, minimizer: int = MINIMIZER) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the removed byte spans."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text, starts, ends, copy in zip(*(batch[c] for c in ("doc_id", "text", "__starts", "__ends", "__copy"))):
                raw = text.encode()
                cuts = _joined(starts, ends, len(raw), copy, length)
                rows.append([doc_id, len(raw), sum(b - a for a, b in cuts), len(cuts),
                             hashlib.sha256(_kept(raw, cuts)).hexdigest(), [a for a, _ in cuts], [b for _, b in cuts]])
            frame = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "starts", "ends"])
            yield frame.astype({"doc_id": "Int64", "kept_sha256": object})

    rows = _with_spans(docs.select("doc_id", text_or_empty().alias("text")), length, minimizer)
    return rows.mapInPandas(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                                 "starts array<int>, ends array<int>")


def without_repeats(docs: DataFrame, length: int = LENGTH, minimizer: int = MINIMIZER) -> DataFrame:
    """``docs`` with all its columns, ``text`` without the removed spans. Spans are drawn in to
    whole characters, so no character is cut apart; a NULL text stays NULL. ``n_chars``, where
    there is one, follows the text."""
    @F.pandas_udf("string")
    def cut(texts: pd.Series, starts: pd.Series, ends: pd.Series, copies: pd.Series) -> pd.Series:
        out = []
        for text, a, b, copy in zip(texts, starts, ends, copies):
            if text is not None:
                raw = text.encode()
                cuts = [(_whole(raw, x, 1), _whole(raw, y, -1)) for x, y in _joined(a, b, len(raw), copy, length)]
                text = _kept(raw, [c for c in cuts if c[0] < c[1]]).decode()
            out.append(text)
        return pd.Series(out, dtype=object)

    def value(name: str) -> Column:
        if name == "text":
            return cut("text", "__starts", "__ends", "__copy").alias("text")
        return F.col(f"`{name}`")

    out = _with_spans(docs, length, minimizer).select(*(value(c) for c in docs.columns))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def _whole(raw: bytes, at: int, step: int) -> int:
    while at < len(raw) and raw[at] & 0xC0 == 0x80:
        at += step
    return at
