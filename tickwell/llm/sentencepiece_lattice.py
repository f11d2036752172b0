"""SentencePiece encoding and decoding as a relational lattice.

Words (a run of word marks and what follows) are cut into parts, runs of characters of one class,
between which the model has no piece (a letter and a full stop, say). Parts are encoded once each,
however often they occur. A part's substrings of bounded length are exploded and joined with the piece table;
what matches are the edges of its lattice. Edges are grouped by the part and folded from
left to right: the state is the last piece of every prefix, and an edge extends the prefix
before it if the model would keep the border between the two pieces. For a model of merges
that is the whole search: exactly one edge fits each prefix. Ids of parts are put together
in the order of each text, and decoded from there to the whole text.

A border is kept unless some merge crosses it in time: a piece of the lattice lies across it, made of
a part at the right edge of the left piece and one at the left edge of the right piece, and
its rank comes before both are used up. The ranks come with the piece table.

Texts are read once, into blocks of documents that hold their words as numbers (Arrow splits and numbers them).
A block gets the ids of its different parts, and puts them together by two takes of lists.

* NULL and empty texts have no pieces.
* Characters without a piece become their bytes.
* Repeated rows and NULL ids: one row for each row.
* Very long texts are taken whole. Parts of more than ``LONG`` characters are cut where no piece
  holds the two characters across the cut, which changes no id; what stays long is folded a
  part at a time, in time linear in its length.
* A text that holds the word mark itself comes back with a space for it, as from the library: no round trip.
* Extra columns are left out, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.llm.common import collected, discard, groups_for, staged, text_or_empty, width
from tickwell.session import fresh_dir, fresh_table, setting

MARK = "▁"
#: Parts in many blocks that are looked up without a shuffle, at most.
FREQUENT = 200_000
#: Characters of a word that is exploded into substrings, or looked up without a shuffle, at most.
LONG = 64
_NEVER = 1 << 30
#: Words whose lattices one task holds.
PER_GROUP = 10_000
_WORD = re.compile(f"{MARK}+[^{MARK}]*")
#: Different words that a Python worker counts before it hands them on, at most.
_REMEMBERED = 200_000
#: Bytes of text in a block of documents, about; a longer text is a block of its own.
BLOCK = 16 << 20


@lru_cache(2)
def piece_rows(model: str) -> list[tuple]:
    """piece, id, rank, whole, left and right parts for every ordinary piece of a model.

    Parts are the pieces along the left (right) edge of how merges build the piece: length,
    rank of the merge that made it, rank of the merge that used it up. ``whole`` is false for
    pieces that no sequence of merges makes. The vocabulary bounds the table."""
    processor = sentencepiece.SentencePieceProcessor(model_file=model)
    ids = [k for k in range(processor.vocab_size()) if not (
        processor.is_byte(k) or processor.is_control(k) or processor.is_unknown(k) or processor.is_unused(k))]
    ids.sort(key=lambda k: (-processor.get_score(k), k))
    rank, before = {}, None
    for number, k in enumerate(ids):
        piece, score = processor.id_to_piece(k), processor.get_score(k)
        rank[piece] = rank[before] if before is not None and score == processor.get_score(ids[number - 1]) else number
        before = piece

    def built(piece: str):
        nodes = [(c, -1, None) for c in piece]
        while len(nodes) > 1:
            found = [(rank[a[0] + b[0]], k) for k, (a, b) in enumerate(zip(nodes, nodes[1:])) if a[0] + b[0] in rank]
            if not found:
                return None
            at, k = min(found)
            nodes[k:k + 2] = [(nodes[k][0] + nodes[k + 1][0], at, (nodes[k], nodes[k + 1]))]
        return nodes[0]

    def parts(node, side: int) -> list[tuple[int, int, int]]:
        out, used = [], _NEVER
        while node is not None:
            out.append((len(node[0]), node[1], used))
            used, node = node[1], node[2][side] if node[2] else None
        return out

    rows = []
    for k in ids:
        piece = processor.id_to_piece(k)
        node = built(piece)
        rows.append((piece, k, rank[piece], node is not None, parts(node, 0), parts(node, 1)))
    return rows


@lru_cache(2)
def joined_rows(model: str) -> list[tuple]:
    """piece, id, whole, left, right, splits for the pieces that can be an edge or lie across a border.

    ``left`` (``right``) has, by length less one, the rank of the merge that used up the part of
    that length at the left (right) edge of the piece; -1 if it has no such part. ``splits`` are the
    ways to make the piece of two others: their lengths, and the rank when both are there and merge."""
    rows = piece_rows(model)
    made = {r[0]: r[2] for r in rows if len(r[0]) > 1}

    def used(parts: list[tuple[int, int, int]], size: int) -> list[int]:
        by_length = {n: rank for n, _, rank in parts}
        return [by_length.get(n, -1) for n in range(1, size + 1)]

    out = []
    for piece, number, rank, whole, left, right in rows:
        splits = []
        for k in range(1, len(piece)):
            a, b = piece[:k], piece[k:]
            if (k == 1 or a in made) and (len(b) == 1 or b in made):
                splits.append((k, len(b), max(rank, made.get(a, -1), made.get(b, -1))))
        if whole or splits:
            out.append((piece, number, whole, used(left, len(piece)), used(right, len(piece)), splits))
    return out


def piece_table(spark: SparkSession, model: str) -> DataFrame:
    return spark.createDataFrame(joined_rows(model), "piece string, id int, whole boolean, left array<int>, right array<int>, "
                                                     "splits array<struct<l:int,r:int,m:int>>")


def byte_ids(model: str) -> dict[int, int]:
    processor = sentencepiece.SentencePieceProcessor(model_file=model)
    return {int(processor.id_to_piece(k)[3:5], 16): k for k in range(processor.vocab_size()) if processor.is_byte(k)}


def _lattice(words: DataFrame, model: str, partitions: int) -> DataFrame:
    """word, ids for distinct words of bounded length. All steps keep the words' partitioning.

    ``edges`` are the lattice in the order of their ends, ``over`` the pieces across each border. The
    fold's state is the last piece of every prefix, and what would take the border after it away: a
    piece across it that the last piece's right edge is still there for. An edge that such a piece
    finds its left edge in does not fit."""
    spark = words.sparkSession
    first_byte = byte_ids(model)[0]
    longest = max(len(r[0]) for r in joined_rows(model))
    starts = words.select("word").repartition(partitions, "word").select(
        "word", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("start"))
    cut = starts.select("word", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("word") - F.col("start")))).alias("n"))
    cut = cut.withColumn("piece", F.expr("substring(word, start + 1, n)"))
    # the piece table has as many rows as the vocabulary; a row's columns go as one struct, so that a list of them is quick to make
    pieces = piece_table(spark, model).select("piece", F.struct("id", "whole", "left", "right", "splits").alias("row"))
    found = cut.join(F.broadcast(pieces), "piece", "left").where("row IS NOT NULL OR n = 1")
    lattice = found.groupBy("word").agg(F.sort_array(F.collect_list(F.struct((F.col("start") + F.col("n")).alias("stop"), "start", "row"))).alias("found"))
    lattice = lattice.select(
        "word", F.expr("filter(found, e -> coalesce(e.row.whole, true))").alias("edges"),
        F.expr("""flatten(transform(filter(found, d -> size(d.row.splits) > 0), d -> transform(d.row.splits, s ->
            struct(d.start + s.l AS at, s.l - 1 AS l, s.r - 1 AS r, s.m AS m))))""").alias("over"))
    state = "struct<start:int,id:int,taken:array<struct<r:int,m:int>>>"
    alone = f"array({_NEVER})"
    # as an argument, since the optimizer would put what makes ``over`` where it is used, once for each edge
    folded = lattice.select("word", F.expr(f"""transform(array(over), o -> aggregate(edges, array(CAST(struct(0, 0, array()) AS {state})), (last, e) ->
        if(size(last) > e.stop OR exists(last[e.start].taken, t -> get(coalesce(e.row.left, {alone}), t.r) >= t.m), last,
           concat(last, array(CAST(struct(e.start, coalesce(e.row.id, -1), transform(
               filter(o, d -> d.at = e.stop AND get(coalesce(e.row.right, {alone}), d.l) > d.m), d -> struct(d.r AS r, d.m AS m))) AS {state}))))))[0]""").alias("last"))
    path = folded.select("word", F.expr("""aggregate(last,
        struct(size(last) - 1 AS at, CAST(array() AS array<struct<start:int,id:int>>) AS path), (p, s) ->
        if(p.at > 0, struct(last[p.at].start AS at,
                            concat(array(struct(last[p.at].start AS start, last[p.at].id AS id)), p.path) AS path), p)).path""").alias("path"))
    # a character without a piece: as many ids as it has bytes, read from hexadecimal
    return path.select("word", F.expr(f"""if(exists(path, x -> x.id < 0),
        flatten(transform(path, x -> if(x.id >= 0, array(x.id), transform(
            sequence(1, length(hex(encode(substring(word, x.start + 1, 1), 'utf-8'))), 2),
            k -> CAST(conv(substring(hex(encode(substring(word, x.start + 1, 1), 'utf-8')), k, 2), 16, 10) AS int) + {first_byte})))),
        transform(path, x -> x.id))""").alias("ids"))


def marked_words(text: str) -> list[str]:
    """The words of a text: space is the word mark, and a text begins with one."""
    return _WORD.findall(MARK + text.replace(" ", MARK)) if text else []


@lru_cache(2)
def crossed(model: str) -> frozenset[str]:
    """Every two characters that stand side by side in some piece. Between any other two no merge
    can happen, so a word may be cut there without changing its pieces."""
    return frozenset(r[0][k:k + 2] for r in piece_rows(model) for k in range(len(r[0]) - 1))


@lru_cache(2)
def part_pattern(model: str) -> str:
    """A pattern for the parts of a word: runs of characters of one class, with the marks before them.

    Two characters that stand side by side in a piece are of one class. So no piece, and no merge,
    lies across two parts, and a word's pieces are those of its parts."""
    parent: dict[str, str] = {}

    def root(c: str) -> str:
        while parent.setdefault(c, c) != c:
            parent[c] = c = parent[parent[c]]
        return c

    for a, b in crossed(model):
        if MARK not in (a, b):
            parent[root(a)] = root(b)
    classes: dict[str, list[str]] = {}
    for c in sorted(parent):
        classes.setdefault(root(c), []).append(c)
    runs = ["[" + "".join(map(re.escape, found)) + "]+" for found in sorted(classes.values(), key=len, reverse=True)]
    return f"{MARK}*(?:{'|'.join(runs + [f'[^{MARK}]'])})|{MARK}+"


@lru_cache(2)
def _compiled(pattern: str) -> re.Pattern:
    return re.compile(pattern)


def parts_of(word: str, pattern: str, pairs: frozenset[str]) -> list[str]:
    """The parts of a word; those of more than ``LONG`` characters are cut wherever no piece crosses."""
    parts = _compiled(pattern).findall(word)
    if len(word) <= LONG:
        return parts
    out = []
    for part in parts:
        start = 0
        if len(part) > LONG:
            for k in range(1, len(part)):
                if part[k - 1:k + 1] not in pairs:
                    out.append(part[start:k])
                    start = k
        out.append(part[start:])
    return out


def fold(word: str, pieces: dict[str, tuple], first_byte: int) -> list[int]:
    """The same lattice and fold for one word of any length, in time linear in it: edges are
    looked up when their end is reached, and only the piece that ends each prefix is kept."""
    longest = max(map(len, pieces))
    starts, rows = [0], [None]
    alone = (None, None, True, [(1, -1, _NEVER)], [(1, -1, _NEVER)])

    def lost(start: int, right: list, left: list) -> bool:
        for n, made, used in right:
            for m, made_too, used_too in left:
                over = pieces.get(word[start - n:start + m])
                if over is not None and (at := max(over[1], made, made_too)) < used and at <= used_too:
                    return True
        return False

    for stop in range(1, len(word) + 1):
        for start in range(stop - 1, max(-1, stop - 1 - longest), -1):
            row = pieces.get(word[start:stop], alone if start == stop - 1 else None)
            if row is not None and row[2] and (not start or not lost(start, rows[start][4], row[3])):
                starts.append(start)
                rows.append(row)
                break
    ids, stop = [], len(word)
    while stop:
        start = starts[stop]
        ids.append([rows[stop][0]] if rows[stop] is not alone else [first_byte + b for b in word[start:stop].encode()])
        stop = starts[stop]
    return [k for some in reversed(ids) for k in some]


def encode_long(words: DataFrame, model: str) -> DataFrame:
    """word, ids for distinct words of any length, a word at a time."""
    shared = words.sparkSession.sparkContext.broadcast((piece_rows(model), byte_ids(model)[0]))

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = None
        for batch in batches:
            for word in batch.column("word").to_pylist():
                if pieces is None:
                    pieces = {r[0]: r[1:] for r in shared.value[0]}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([word], pa.string()), pa.array([fold(word, pieces, shared.value[1])], pa.list_(pa.int32()))], ["word", "ids"])

    return words.select("word").mapInArrow(folded, "word string, ids array<int>")


def _encoded(words: DataFrame, model: str, partitions: int) -> DataFrame:
    """word, ids for distinct words."""
    short = _lattice(words.where(F.length("word") <= LONG), model, partitions)
    long = encode_long(words.where(F.length("word") > LONG).select("word").repartition("word"), model)
    return short.unionByName(long)


def encode_words(words: DataFrame, model: str, partitions: int) -> DataFrame:
    """word, ids, decoded for distinct words."""
    return decode_words(_encoded(words, model, partitions), model)


def _codes(model: str) -> list[bytes]:
    """The bytes of every id, with a space for the mark."""
    table = {r[1]: r[0].replace(MARK, " ").encode() for r in piece_rows(model)} | {k: bytes([b]) for b, k in byte_ids(model).items()}
    return [table.get(k, b"") for k in range(max(table) + 1)]


def decode_words(encoded: DataFrame, model: str) -> DataFrame:
    """word, ids, decoded: the bytes of the ids put together in order."""
    shared = encoded.sparkSession.sparkContext.broadcast(_codes(model))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [b"".join([shared.value[k] for k in ids]).decode("utf-8", "replace").replace(" ", MARK) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("ids"), pa.array(texts, pa.string())],
                                             ["word", "ids", "decoded"])

    return encoded.select("word", "ids").mapInArrow(decoded, "word string, ids array<int>, decoded string")


def vocabulary(docs: DataFrame, model: str | None = None) -> DataFrame:
    """word, n: every word of all texts and how often it occurs; every part of a word, if the model is given."""
    cuts = docs.sparkSession.sparkContext.broadcast((part_pattern(model), crossed(model)) if model else None)

    def given(words: Counter[str]) -> pa.RecordBatch:
        found = words
        if cuts.value is not None:
            found = Counter()
            for word, n in words.items():
                for part in parts_of(word, *cuts.value):
                    found[part] += n
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                words.update(marked_words(text))
                if len(words) > _REMEMBERED:
                    yield given(words)
                    words = Counter()
        if words:
            yield given(words)

    texts = docs.select(text_or_empty().alias("text"))
    return texts.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _partitions(words: DataFrame) -> int:
    return max(width(words.sparkSession), groups_for(words.count(), PER_GROUP))


def _cut(words: pa.Array, model: str) -> pa.ListArray:
    """The parts of every word of a list, as ``parts_of`` gives them. Words have no space, so it can part them."""
    pattern = part_pattern(model)
    parted = pc.replace_substring_regex(words, f"({pattern})", r"\1 ")
    lists = pc.split_pattern(pc.ascii_rtrim(parted, characters=" "), " ")
    long = np.flatnonzero(pc.greater(pc.utf8_length(words), LONG).to_numpy(zero_copy_only=False))
    if not len(long):
        return lists
    apart = pa.array([parts_of(w, pattern, crossed(model)) for w in words.take(pa.array(long)).to_pylist()], pa.list_(pa.string()))
    place = np.arange(len(words))
    place[long] = len(words) + np.arange(len(long))
    return pa.concat_arrays([lists, apart]).take(pa.array(place))


def _split(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """How many words each text has, and the words of all texts in order. The same words as ``marked_words``: of
    spaces in a row the first one ends a word, and the others are marks of the next."""
    spaced = pc.binary_join_element_wise(" ", pc.replace_substring(texts, MARK, " "), "")
    spaced = pc.replace_substring(pc.replace_substring(spaced, "  ", f" {MARK}"), f"{MARK} ", MARK + MARK)
    spaced = pc.ascii_ltrim(spaced, characters=" ")
    lists = pc.split_pattern(pc.if_else(pc.equal(pc.binary_length(texts), 0), None, spaced), " ")
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False), lists.flatten().dictionary_encode()


def _packed(numbers: np.ndarray, firsts: bool = True) -> bytes:
    """Numbers that count up at each first use, which is written as 0, and others as they are plus 1; by byte planes."""
    if firsts:
        before = np.concatenate([[-1], np.maximum.accumulate(numbers)[:-1]])
        numbers = np.where(numbers > before, 0, numbers + 1)
    return pa.compress(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, size: int, firsts: bool = True) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 4 * size, codec="zstd", asbytes=True), np.uint8)
    numbers = np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").ravel()
    return np.where(numbers == 0, np.cumsum(numbers == 0) - 1, numbers - 1).astype(np.int32) if firsts else numbers


def _ends(sizes) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)


def _block(number: int, ids: pa.Array, texts: pa.Array, model: str) -> pa.RecordBatch:
    n_words, words = _split(texts)
    lists = _cut(pc.binary_join_element_wise(MARK, words.dictionary, ""), model)
    parts = lists.flatten().dictionary_encode()
    digests = [hashlib.sha256(t).digest() for t in texts.cast(pa.binary()).to_pylist()]
    one = {"block": pa.array([number], pa.int64())}
    for name, column in (("doc_id", ids), ("n_bytes", pc.binary_length(texts).cast(pa.int64())), ("n_words", pa.array(n_words, pa.int64())),
                         ("digest", pa.array(digests, pa.binary())), ("parts", parts.dictionary)):
        one[name] = pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)
    for name, column in (("words", words.indices), ("cuts", pc.list_value_length(lists)), ("cut", parts.indices)):
        one[name] = pa.array([_packed(column.to_numpy(zero_copy_only=False), name != "cuts")], pa.binary())
        one[f"n_{name}" if name != "words" else "n_all"] = pa.array([len(column)], pa.int64())
    return pa.RecordBatch.from_arrays(list(one.values()), list(one))


def blocks(docs: DataFrame, model: str) -> DataFrame:
    """Documents in blocks of about ``BLOCK`` bytes of text: ids, sizes and digests of the texts, their words in order as
    numbers of the block's different words, those as numbers of its different parts, and the parts."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, count, size, ids, texts = TaskContext.get().partitionId() << 32, 0, 0, [], []
        for batch in batches:
            at, column = 0, batch.column("text")
            ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
            while at < len(column):
                before = ends[at - 1] if at else 0
                stop = min(len(column), int(np.searchsorted(ends, before + BLOCK - size)) + 1)
                ids.append(batch.column("doc_id").slice(at, stop - at))
                texts.append(column.slice(at, stop - at))
                size, at = size + int(ends[stop - 1] - before), stop
                if size >= BLOCK:
                    yield _block(first + count, pa.concat_arrays(ids), pa.concat_arrays(texts), model)
                    count, size, ids, texts = count + 1, 0, [], []
                    pa.default_memory_pool().release_unused()
        if texts:
            yield _block(first + count, pa.concat_arrays(ids), pa.concat_arrays(texts), model)

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        made, f"block long, doc_id array<{kind}>, n_bytes array<long>, n_words array<long>, digest array<binary>, parts array<string>, "
              "words binary, n_all long, cuts binary, n_cuts long, cut binary, n_cut long")


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_bytes, n_words, n_pieces, ids of whole texts in order, and round_trip: whether
    decoding all ids of a text gives back that text (the bytes are compared by their SHA-256).

    Texts are read once and kept as blocks of numbers, bucketed by block. Parts of words are encoded once each; the ids
    come to a block once for each different part of it, so a part's rows are as many as there are blocks. Parts that most
    blocks have, bounded in number and length, are looked up there without a shuffle."""
    spark = docs.sparkSession
    held = _bucketed(blocks(docs, model))
    rows = held.select("block", F.posexplode("parts").alias("number", "word"))
    words = staged(rows.groupBy("word").agg(F.count("*").alias("n")), "lattice-words")
    # a task holds few words, so their lattices need no sort
    with setting(spark, "spark.sql.objectHashAggregate.sortBased.fallbackThreshold", str(4 * PER_GROUP)):
        known = staged(_encoded(words, model, _partitions(words)), "lattice-encoded")
    collected(spark)
    common = words.where((F.length("word") <= LONG) & (F.col("n") > 1)).orderBy(F.desc("n"), "word").limit(FREQUENT)
    head = staged(common.join(known, "word").select("word", "ids"), "lattice-head")
    discard(words)
    far = rows.join(F.broadcast(head.select("word")), "word", "left_anti").join(known.hint("merge"), "word")
    found = staged(far.select(F.col("block").alias("of"), "number", "ids"), "lattice-found")
    discard(known)
    collected(spark)
    near = head.toArrow().combine_chunks()
    shared = spark.sparkContext.broadcast((near.column("word").combine_chunks(), near.column("ids").combine_chunks(), _codes(model)))

    def joined(held: pa.Table, found: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()  # what the block before this one took
        row = {name: held.column(name)[0] for name in held.column_names}
        near, near_ids, codes = shared.value
        parts = row["parts"].values
        # where a part's ids are: among the near ones, or behind them among those that were joined
        place = pc.fill_null(pc.index_in(parts, value_set=near), -1).to_numpy(zero_copy_only=False).copy()
        place[found.column("number").to_numpy()] = len(near) + np.arange(len(found))
        kind = pa.list_(pa.int32())
        ids = pa.concat_arrays([near_ids.cast(kind), *(c.cast(kind) for c in found.column("ids").chunks)])
        # parts to words, words to texts: ids stay in order, and only their ends are looked up
        by_part = ids.take(pa.array(place[_unpacked(row["cut"].as_py(), row["n_cut"].as_py())]))
        ends = by_part.offsets.to_numpy()[_ends(_unpacked(row["cuts"].as_py(), row["n_cuts"].as_py(), False))]
        by_word = pa.ListArray.from_arrays(pa.array(ends), by_part.values).take(pa.array(_unpacked(row["words"].as_py(), row["n_all"].as_py())))
        ends = by_word.offsets.to_numpy()[_ends(row["n_words"].values)]
        starts, data = pa.array(codes, pa.binary()).take(by_word.values).buffers()[1:]
        at = np.frombuffer(starts, np.int32)[ends]
        view = memoryview(data) if data is not None else memoryview(b"")
        # the mark before the first word is not of the text
        back = [hashlib.sha256(view[a + 1:b]).digest() for a, b in zip(at.tolist(), at[1:].tolist())]
        return pa.table({
            "doc_id": row["doc_id"].values, "n_bytes": row["n_bytes"].values, "n_words": row["n_words"].values,
            "n_pieces": pa.array(np.diff(ends), pa.int64()), "ids": pa.ListArray.from_arrays(pa.array(ends), by_word.values),
            "round_trip": pc.equal(row["digest"].values, pa.array(back, pa.binary()))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return held.groupBy("block").cogroup(found.groupBy("of")).applyInArrow(
        joined, f"doc_id {kind}, n_bytes long, n_words long, n_pieces long, ids array<int>, round_trip boolean")


def _bucketed(blocks: DataFrame) -> DataFrame:
    """Blocks as a table bucketed by their numbers, so that they need no shuffle to meet their parts."""
    spark = blocks.sparkSession
    name = fresh_table(spark, "blocks")
    with (setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "2000"),
          setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", "16m"),
          setting(spark, "spark.sql.parquet.compression.codec", "zstd")):
        blocks.write.bucketBy(width(spark), "block").format("parquet").option("path", fresh_dir(spark, "lattice-blocks")).saveAsTable(name)
    return spark.table(name)


def piece_counts(docs: DataFrame, model: str) -> DataFrame:
    """What ``encode`` gives, without the ids."""
    return encode(docs, model).drop("ids")
