"""Similarity join of texts on the Jaccard similarity of their word n-gram sets, by MinHash banding.

Texts with equal sets are one representative with a count. The band and row counts follow from the recall wanted at the threshold.
Representatives that share a band hash lie in one bucket. Buckets of the same members are one; inside a bucket two texts are candidates if
their MinHash values agree as often as those of texts at the threshold do, so that texts which share a band by chance, or only because
they are a little alike, do not chain up to groups. Candidates are verified on their full sets, each set sent once where its
group is small. Buckets and groups of any size are cut into blocks, and a task compares two blocks, so neither a task nor a row count grows with the square
of a group: a task gives one row per text, the number of its links, and a spanning forest of them.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from regulus.llm.components import components
from regulus.llm.shingles import Banding, set_id, sets_of
from regulus.llm.store import written
from regulus.llm.words import words_of

#: Words of a gram, the least similarity as a fraction, the recall wanted there, rows of a band.
GRAM, SIMILARITY, RECALL, ROWS = 5, (4, 5), 0.99999, 6
#: Texts of a block whose full sets are compared, and of a block of a bucket, where only MinHash values are.
BLOCK, BUCKET_BLOCK = 256, 2048


def banding_for(similarity: float, recall: float = RECALL, rows: int = ROWS) -> Banding:
    """The fewest bands of ``rows`` rows that reach the recall."""
    return Banding(int(np.ceil(np.log(1 - recall) / np.log(1 - similarity ** rows))), rows)


def _signed(df: DataFrame, text: str, carry: tuple[str, ...], gram: int, banding: Banding) -> DataFrame:
    """carry, text_hash, set_id (null for a text without words), n_grams, bands and a byte of each MinHash value of each row."""
    rows = df.select(*carry, F.col(text).cast("string").alias("__text"), F.xxhash64(F.col(text).cast("string")).alias("__hash"))

    def sign(batches):
        for batch in batches:
            ids, sizes, bands, values = [], [], [], []
            for words in words_of(batch.column("__text")):
                sets = sets_of(words, gram)
                full = [s for s in sets if len(s)]
                hashes = zip(*banding.of(full))
                for s in sets:
                    ids.append(set_id(s) if len(s) else None)
                    sizes.append(len(s))
                    band, value = next(hashes) if len(s) else (None, None)
                    bands.append(band.tobytes() if len(s) else None)
                    values.append(value.tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in carry], batch.column("__hash"), pa.array(ids, pa.binary()), pa.array(sizes, pa.int32()), pa.array(bands, pa.binary()),
                 pa.array(values, pa.binary())], names=[*carry, "text_hash", "set_id", "n_grams", "bands", "minima"])

    schema = StructType([*[rows.schema[c] for c in carry], StructField("text_hash", LongType()), StructField("set_id", BinaryType()),
                         StructField("n_grams", IntegerType()), StructField("bands", BinaryType()), StructField("minima", BinaryType())])
    return rows.mapInArrow(sign, schema)


def _tasks(members: DataFrame, group: str, block: int, bundles: int) -> DataFrame:
    """``members`` (with ``size``, the members of their group) with ``task`` and ``side``: 0 where a block meets itself, else 1 and 2.

    Small groups come many to a task. The others are cut into blocks, and every two blocks of a group are a task: its rows are copied as often as
    the group has blocks.
    """
    blocks = F.ceil(F.col("size") / block).cast("int")
    placed = (members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    name: Column = F.col(group) if dict(members.dtypes)[group] != "binary" else F.hex(group)
    task = F.when(F.col("blocks") == 1, F.concat(F.lit("b"), F.pmod(F.xxhash64(group), F.lit(bundles)))).otherwise(
        F.concat_ws("-", name.cast("string"), F.least("own", "other").cast("string"), F.greatest("own", "other").cast("string")))
    return placed.withColumn("task", task).withColumn("side", F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)).drop("blocks", "own", "other", "size")


def _groups(names: pa.ChunkedArray) -> list[np.ndarray]:
    """The places of each group's rows."""
    codes = names.combine_chunks().dictionary_encode()
    codes = (codes.chunk(0) if isinstance(codes, pa.ChunkedArray) else codes).indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(codes[order])) + 1)


def _plausible(rows: pa.Table, similarity: tuple[int, int], agreeing: int) -> pa.Table:
    """A spanning forest of the candidates of each bucket (or between two of its blocks)."""
    over, under = similarity
    side, sizes = rows["side"].to_numpy(), rows["n_grams"].to_numpy().astype(np.int64)
    minima = np.frombuffer(b"".join(rows["minima"].to_pylist()), dtype=np.uint8).reshape(rows.num_rows, -1)
    a, b = [], []
    for members in _groups(rows["key"]):
        own, n = minima[members], sizes[members]
        far = side[members]
        crossed = far.any()
        free = np.ones(len(members), dtype=bool)
        for start in range(len(members)):
            if not free[start]:
                continue
            free[start], reached = False, [start]
            while reached and free.any():
                i = reached.pop()
                near = np.flatnonzero(free & (far != far[i])) if crossed else np.flatnonzero(free)
                near = near[np.minimum(n[near], n[i]) * under >= np.maximum(n[near], n[i]) * over]
                near = near[(own[near] == own[i]).sum(axis=1) >= agreeing]
                free[near] = False
                a += [members[i]] * len(near)
                b += members[near].tolist()
                reached += near.tolist()
    ids = rows["set_id"]
    return pa.table([ids.take(pa.array(a, pa.int64())), ids.take(pa.array(b, pa.int64()))], names=["a", "b"])


def _candidates(sets: DataFrame, banding: Banding, similarity: tuple[int, int], block: int = BUCKET_BLOCK) -> DataFrame:
    """(node, root): the group of every representative that has a candidate."""
    def split(batches):
        for batch in batches:
            bands = np.frombuffer(b"".join(batch.column("bands").to_pylist()), dtype=np.int64).reshape(-1, banding.bands)
            # the number of the band is part of the hash
            keys = (bands + np.arange(banding.bands) * np.int64(0x1000000000000061)) ^ np.arange(banding.bands)
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), batch.column("set_id").take(pa.array(np.repeat(np.arange(batch.num_rows), banding.bands)))],
                                             names=["key", "set_id"])

    members = sets.select("set_id", "bands").mapInArrow(split, "key long, set_id binary")
    # one per bucket, added up on the map side: a hot band is a few rows
    many = members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    shared = written(members.join(many.hint("merge"), "key"), "members")
    # buckets of the same members need one look: two sums without order name the members
    sums = shared.groupBy("key").agg(F.first("size").alias("size"), F.bit_xor(F.xxhash64("set_id")).alias("x"), F.bit_xor(F.xxhash64("set_id", F.lit(1))).alias("y"))
    kept = sums.groupBy("size", "x", "y").agg(F.min("key").alias("key")).select("key")
    asked = shared.join(kept.hint("merge"), "key", "left_semi").join(sets.select("set_id", "n_grams", "minima").hint("merge"), "set_id")
    bundles = max(1, shared.count() // 4000)
    agreeing = banding.least_agreeing(similarity[0] / similarity[1])
    links = _tasks(asked, "key", block, bundles).groupBy("task").applyInArrow(lambda t: _plausible(t, similarity, agreeing), "a binary, b binary")
    return components(links)


def _verify(rows: pa.Table, similarity: tuple[int, int], agreeing: int) -> pa.Table:
    """Compare two blocks of a group (or one with itself); groups of one block come many at a time."""
    over, under = similarity
    out: list[tuple] = []
    side = rows["side"].to_numpy()
    minima = np.frombuffer(b"".join(rows["minima"].to_pylist()), dtype=np.uint8).reshape(rows.num_rows, -1)
    weights, ids = rows["n"].to_numpy(), rows["set_id"].to_pylist()
    grams = [np.frombuffer(x, dtype=np.uint64) for x in rows["grams"].to_pylist()]
    for members in _groups(rows["root"]):
        alone = not side[members].any()
        left, right = (members, members) if alone else (members[side[members] == 1], members[side[members] == 2])
        if len(right) < 1 or len(left) < 1:
            continue
        lengths = np.array([len(grams[i]) for i in right])
        joined, starts = np.concatenate([grams[i] for i in right]), np.concatenate([[0], np.cumsum(lengths)[:-1]])
        links = dict.fromkeys(members.tolist(), 0)
        parent = {int(i): int(i) for i in members}

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for place, i in enumerate(left.tolist()):
            n = len(grams[i])
            partners = np.flatnonzero(np.minimum(lengths, n) * under >= np.maximum(lengths, n) * over)
            if alone:
                partners = partners[partners > place]
            partners = partners[(minima[right[partners]] == minima[i]).sum(axis=1) >= agreeing]
            if not len(partners):
                continue
            if len(partners) * 4 > len(right):
                at = np.minimum(np.searchsorted(grams[i], joined), n - 1)
                shared = np.add.reduceat((grams[i][at] == joined).astype(np.int64), starts)[partners]
            else:
                shared = np.array([len(np.intersect1d(grams[i], grams[right[p]], assume_unique=True)) for p in partners])
            linked = partners[shared * (over + under) >= over * (n + lengths[partners])]
            for j in right[linked].tolist():
                links[i] += int(weights[j])
                links[j] += int(weights[i])
                a, b = root(i), root(j)
                if a != b:
                    parent[a] = b
        for i in links:
            if links[i]:
                out.append((ids[i], links[i], ids[root(i)]))
    schema = pa.schema([("set_id", pa.binary()), ("links", pa.int64()), ("linked_to", pa.binary())])
    return pa.table([pa.array([r[k] for r in out], schema.field(k).type) for k in range(3)], schema=schema)


def similar(df: DataFrame, text: str = "text", doc_id: str = "doc_id", gram: int = GRAM, similarity: tuple[int, int] = SIMILARITY,
            recall: float = RECALL, block: int = BLOCK, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``df``: doc_id, class_id, n_links, class_key and the columns named in ``carry``.

    Two rows are linked if the similarity of their sets reaches the fraction ``similarity``; a class is a connected component of links, told by
    its class_key and named after its least doc_id. Repeated rows and equal sets are linked to one another. A text of fewer words than a
    gram is one gram; a null text or one without words has no grams, no links, no class_key and a class of its own (its doc_id). Rows
    without an id count as members. Other columns are not read, so their names cannot clash; a carried one may not have the name of a column of the
    result or of a step before it (ValueError). An empty table gives an empty one.
    """
    taken = {"doc_id", "text", "class_id", "n_links", "class_key", "text_hash", "set_id", "n_grams", "bands", "minima"}.intersection(c.lower() for c in carry)
    if taken:
        raise ValueError(f"carried columns need other names: {sorted(taken)}")
    banding = banding_for(similarity[0] / similarity[1], recall)
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), *carry)
    rows = written(_signed(docs, "text", ("doc_id", *carry), gram, banding), "signed")
    sets = written(rows.where("set_id is not null").groupBy("set_id").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("least_id"), F.first("bands").alias("bands"),
        F.first("minima").alias("minima"), F.first("n_grams").alias("n_grams"), F.min("text_hash").alias("text_hash")), "sets")
    groups = _candidates(sets, banding, similarity)
    asked = written(groups.withColumnRenamed("node", "set_id").join(sets.drop("bands", "n_grams"), "set_id"), "candidates")
    found = written(_links(docs, "text", asked, gram, similarity, block, banding.least_agreeing(similarity[0] / similarity[1])), "found")
    linked = components(found.select(F.col("set_id").alias("a"), F.col("linked_to").alias("b")))
    sums = found.groupBy("set_id").agg(F.sum("links").alias("links"))
    own = (sets.select("set_id", "n", "least_id").join(sums, "set_id", "left").join(linked.withColumnRenamed("node", "set_id"), "set_id", "left")
           .withColumn("class_key", F.coalesce("root", "set_id")))
    named = own.groupBy("class_key").agg(F.min("least_id").alias("class_id"))
    classes = written(own.join(named, "class_key").select("set_id", "class_key", "class_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "classes")
    # texts without words would meet in one task: they need no partner
    columns = ["doc_id", "class_id", "n_links", "class_key", *carry]
    alone = rows.where("set_id is null").select("*", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("binary").alias("class_key"))
    return rows.where("set_id is not null").join(classes, "set_id").select(*columns).unionByName(alone.select(*columns))


def one_of_each(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``df`` without near copies: of every class the row with the least doc_id stays, a row without id only if none has one.

    Texts without words are no copies of one another and all stay.
    """
    numbered = written(df.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    found = written(similar(numbered, text, doc_id, carry=("__row",)).select("doc_id", "class_key", "__row"), "classed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("__row").alias("c")))
    kept = found.where("class_key is not null").groupBy("class_key").agg(first.alias("first")).select(F.col("first.c").alias("__row"))
    kept = kept.unionByName(found.where("class_key is null").select("__row"))
    # as above: the rows to keep grow with the input
    return numbered.join(kept.hint("merge"), "__row", "left_semi").drop("__row")


def _links(df: DataFrame, text: str, asked: DataFrame, gram: int, similarity: tuple[int, int], block: int, agreeing: int) -> DataFrame:
    """(set_id, links, linked_to) of the verified pairs of all groups."""
    wanted = asked.select(F.col("text_hash").alias("__hash"), "set_id")
    texts = df.select(F.col(text).cast("string").alias("__text"), F.xxhash64(F.col(text).cast("string")).alias("__hash"))
    # the same join at every size: the wanted texts grow with the input, so they are never sent whole to all executors
    texts = texts.join(wanted.select("__hash").distinct().hint("merge"), "__hash", "left_semi").groupBy("__hash").agg(F.first("__text").alias("__text"))

    def fill(batches):
        for batch in batches:
            ids, sets = [], []
            for words in words_of(batch.column("__text")):
                for s in sets_of(words, gram):
                    ids.append(set_id(s))
                    sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(sets, pa.binary())], names=["set_id", "grams"])

    sets = texts.mapInArrow(fill, "set_id binary, grams binary")
    full = written(asked.select("set_id", "root", "n", "minima").join(sets, "set_id"), "grams")
    sizes = full.groupBy("root").agg(F.count("*").alias("size"))
    tasks = _tasks(full.join(sizes, "root"), "root", block, max(1, full.count() // 1000))
    return tasks.groupBy("task").applyInArrow(lambda t: _verify(t, similarity, agreeing), "set_id binary, links long, linked_to binary")
