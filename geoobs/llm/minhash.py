"""Near-duplicate documents by an inverted join over MinHash signature coordinates.

Documents with equal shingle sets are one class. A class is posted under coordinate-value pairs of
its signature. Two signatures of K coordinates that agree in at least T must share one of the K - T + 1
rarest pairs of either, so only these are posted (prefix), and lists of one class are skipped. Within
a list, collisions of whole signatures are counted, and classes that agree in T or more are joined
into candidate clusters; every link lies within one. Clusters are then confirmed on full shingle sets.

Nothing emits pairs: lists and clusters are searched breadth-first and yield the links of a spanning
forest, at most one for each member. Both are dealt into tiles of bounded size, so a group of any
size is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, col, fresh, stored
from .components import connected_components
from .sorted_cells import sorted_cells

WORDS = 4
SIMILAR = 0.8
COORDINATES = 64
# At similarity 0.8 fewer than 36 of 64 coordinates agree with a chance of about 3 in a million.
AGREE = 36
TILE = 4096
COUNTERS, COUNTER_BLOCK = 1 << 18, 1 << 14

_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values; a bijection."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _odd(n: int, start: int) -> np.ndarray:
    return _mixed(np.arange(start, start + n, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1)


def shingles(raw: bytes, words: int) -> np.ndarray:
    """Distinct shingles of ``words`` words as sorted 64-bit hashes.

    A-Z count as a-z, words are runs of anything but ASCII blanks. With fewer words, the whole
    sequence is one shingle, told apart from longer ones; without words there is none.
    """
    each = raw.lower().split()
    if not each:
        return np.empty(0, np.uint64)
    hashed = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, each)), ">u8").astype(np.uint64)
    n = min(words, len(hashed))
    weights = _odd(words + 1, 1)
    out = np.full(len(hashed) - n + 1, _U(n) * weights[words])
    for i in range(n):
        out += hashed[i:len(hashed) - n + 1 + i] * weights[i]
    return np.unique(_mixed(out))


def signature(found: np.ndarray, coordinates: int, chunk: int = 1 << 13) -> np.ndarray:
    """MinHash values, 32 bits each."""
    factors = _odd(coordinates, 1000)
    least = np.full(coordinates, ~_U(0))
    for at in range(0, len(found), chunk):
        part = found[at:at + chunk, None] * factors
        np.minimum(least, part.min(0), out=least)
    return (least >> _U(32)).astype("<u4")


def fingerprint(found: np.ndarray) -> bytes:
    """128 bits that tell shingle sets apart."""
    sums = [_mixed(found + _U(salt)).sum(dtype=np.uint64) for salt in (0x51, 0xA7)]
    return b"".join(int(s).to_bytes(8, "big") for s in sums)


def _signed(text: str, words: int, coordinates: int):
    kind = pa.struct([("n", pa.int64()), ("node", pa.binary()), ("signature", pa.binary())])

    @F.arrow_udf("struct<n:bigint,node:binary,signature:binary>")
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for at in range(0, len(batch), 256):
                for raw in batch.slice(at, 256).to_pylist():
                    s = shingles(raw, words)
                    rows.append(
                        {"n": len(s), "node": fingerprint(s),
                         "signature": signature(s, coordinates).tobytes()}
                        if len(s) else {"n": 0, "node": None, "signature": None}
                    )
            yield pa.array(rows, type=kind)

    return sign(bytes_of(text))


def _token(values: np.ndarray) -> np.ndarray:
    """64-bit names of the coordinate-value pairs of signatures, one row each."""
    place = np.arange(values.shape[1], dtype=np.uint64) << _U(32)
    return _mixed(values.astype(np.uint64) | place)


def _matrix(column: pa.Array, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


def _popularity(classes: DataFrame) -> np.ndarray:
    """How many pairs fall on each of a fixed number of counters: the common order of all prefixes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, dtype=np.int32)
        for batch in batches:
            if batch.num_rows:
                tokens = _token(_matrix(batch.column(0), "<u4"))
                total += np.bincount((tokens % _U(COUNTERS)).ravel().astype(np.int64),
                                     minlength=COUNTERS).astype(np.int32)
        blocks = total.reshape(-1, COUNTER_BLOCK)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(blocks)), pa.int32()),
             pa.array([b.tobytes() for b in blocks], pa.binary())], names=["block", "counts"]
        )

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, np.int32) for b in rows["counts"].to_pylist())
        return pa.table({"block": rows["block"][:1], "counts": pa.array([total.tobytes()],
                                                                        pa.binary())})

    kind = "block int, counts binary"
    parts = classes.select("signature").mapInArrow(count, kind)
    # Partial sums are added up in two steps, a fixed number of counters whatever the input.
    parts = parts.groupBy("block").applyInArrow(add, kind).collect()
    out = np.zeros(COUNTERS, dtype=np.int32)
    for block, counts in parts:
        out[block * COUNTER_BLOCK:(block + 1) * COUNTER_BLOCK] = np.frombuffer(counts, np.int32)
    return out


def _prefixes(classes: DataFrame, coordinates: int, agree: int) -> DataFrame:
    """Postings of each class under its rarest pairs: ``token``, ``node``."""
    counts = classes.sparkSession.sparkContext.broadcast(_popularity(classes))
    size = coordinates - agree + 1

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = _token(_matrix(batch.column(1), "<u4"))
            rarity = counts.value[(tokens % _U(COUNTERS)).astype(np.int64)]
            order = np.lexsort((tokens, rarity), axis=1)[:, :size]
            chosen = np.take_along_axis(tokens, order, 1).ravel().view(np.int64)
            nodes = batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), size)))
            yield pa.RecordBatch.from_arrays([pa.array(chosen), nodes], names=["token", "node"])

    return classes.select("node", "signature").mapInArrow(post, "token bigint, node binary")


def _tiles(members: DataFrame, group: str, tile: int) -> DataFrame:
    """Deals the members of each group into ``cell``s that hold any two of them together.

    ``members`` has the group's ``size``. A group of up to ``tile`` members is one cell; a larger one
    is cut into parts of about half that, and every two parts meet in a cell.
    """
    parts = F.when(F.col("size") <= tile, F.lit(1)).otherwise(
        F.ceil(F.col("size") * 2 / F.lit(tile))
    ).cast("int")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    spread = members.withColumn("parts", parts).withColumn("part", part).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    ).filter("parts = 1 OR part <> other")
    # A part meets itself in the cells with others, so a cell of one part alone is not needed.
    return spread.withColumn(
        "cell", F.xxhash64(group, F.least("part", "other"), F.greatest("part", "other"))
    ).drop("parts", "part", "other", "size")


def _forest(n: int, near) -> Iterator[tuple[int, int]]:
    """Links of a spanning forest; ``near(i, others)`` says which of ``others`` link with ``i``."""
    open_ = np.arange(n)
    while len(open_):
        queue, open_ = [int(open_[0])], open_[1:]
        while queue and len(open_):
            i = queue.pop()
            met = near(i, open_)
            for j in open_[met]:
                yield i, int(j)
                queue.append(int(j))
            open_ = open_[~met]


_LINKS = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _links(found: Iterator[tuple[bytes, bytes]]) -> pa.RecordBatch:
    pairs = list(found)
    return pa.RecordBatch.from_arrays(
        [pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], schema=_LINKS
    )


def _by_signature(agree: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in sorted_cells(batches):
            if cell.num_rows > 1:
                nodes = cell["node"].to_pylist()
                rows = _matrix(cell["signature"].combine_chunks(), "<u4")
                yield _links(
                    (nodes[i], nodes[j]) for i, j in _forest(
                        len(nodes), lambda i, o: (rows[o] == rows[i]).sum(1) >= agree)
                )

    return search


def _by_shingles(words: int, similar: float):
    """Links with intersection / union >= similar, in whole numbers of a hundredth."""
    share = round(similar * 100)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in sorted_cells(batches):
            if cell.num_rows < 2:
                continue
            nodes = cell["node"].to_pylist()
            sets = [shingles(raw, words) for raw in cell["text"].to_pylist()]
            size = np.array(list(map(len, sets)))
            names, flat = np.unique(np.concatenate(sets), return_inverse=True)
            ends = np.concatenate([[0], np.cumsum(size)])
            mark = np.zeros(len(names), dtype=bool)

            def near(i: int, others: np.ndarray) -> np.ndarray:
                out = np.zeros(len(others), dtype=bool)
                # A set much larger or smaller than the other can't share enough.
                least = np.minimum(size[others], size[i])
                may = np.flatnonzero(100 * least >= share * np.maximum(size[others], size[i]))
                if len(may):
                    mark[flat[ends[i]:ends[i + 1]]] = True
                    both = np.array([mark[flat[ends[j]:ends[j + 1]]].sum() for j in others[may]])
                    mark[flat[ends[i]:ends[i + 1]]] = False
                    union = size[others[may]] + size[i] - both
                    out[may] = 100 * both >= share * union
                return out

            yield _links((nodes[i], nodes[j]) for i, j in _forest(len(nodes), near))

    return search


def _search(members: DataFrame, group: str, payload: str, tile: int, search) -> DataFrame:
    cells = _tiles(members, group, tile).select("cell", "node", payload)
    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(
        search, "a binary, b binary"
    )


def _sized(members: DataFrame, group: str) -> DataFrame:
    """Members of groups of two and more, with the ``size`` of their group."""
    sizes = members.groupBy(F.col(group).alias("_g")).agg(F.count("*").alias("size"))
    return members.join(sizes.filter("size > 1"), F.col(group) == F.col("_g")).drop("_g")


def near_duplicates(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", *, words: int = WORDS,
    similar: float = SIMILAR, coordinates: int = COORDINATES, agree: int = AGREE,
    tile: int = TILE,
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for every row.

    Two documents are linked if the shares of their distinct ``words``-word shingles have a Jaccard
    similarity of ``similar`` or more; the component is the smallest id reachable by links. Candidate
    pairs are those that agree in ``agree`` of ``coordinates`` MinHash values, links are confirmed on
    full sets of 64-bit shingle hashes.

    A null or blank text has no shingles and links with nothing. A row without an id takes no part;
    its component is null and it is kept. Rows with one id are one document: repeated rows get equal
    answers, different texts under one id share a component. Empty in, empty out.
    """
    signed = stored(
        df.select(
            col(doc_id).alias("doc_id"), F.xxhash64(bytes_of(text)).alias("text_key"),
            _signed(text, words, coordinates).alias("s"),
        ).select("doc_id", "text_key", F.col("s.n").alias("n_shingles"), "s.node", "s.signature"),
        "minhash-signatures",
    )
    part = signed.filter("node IS NOT NULL AND doc_id IS NOT NULL")
    classes = stored(
        part.groupBy("node").agg(
            F.min(F.struct("doc_id", "text_key")).alias("row"),
            F.min("signature").alias("signature"),
        ).select("node", F.col("row.doc_id").alias("first"), "row.text_key", "signature"),
        "minhash-classes",
    )
    # Lists of two and more, then the signatures of their members.
    lists = _sized(_prefixes(classes, coordinates, agree), "token")
    lists = lists.join(classes.select("node", "signature"), "node")
    near = _search(lists, "token", "signature", tile, _by_signature(agree))
    clusters = connected_components(near).select(
        "node", F.col("component").alias("cluster")
    )
    members = stored(
        _sized(clusters, "cluster").join(classes.select("node", "first", "text_key"), "node"),
        "minhash-clusters",
    )
    # One text for each class: that of a row with the class's smallest id.
    texts = df.select(col(doc_id).alias("first"), bytes_of(text).alias("text"))
    # Members grow with the documents, so they are never sent to all tasks, however few there are.
    texts = members.hint("merge").join(
        texts.withColumn("text_key", F.xxhash64("text")), ["first", "text_key"]
    )
    links = _search(texts, "cluster", "text", tile, _by_shingles(words, similar))
    # Different texts of one id hold together, as do all rows of a class.
    repeated = part.select("doc_id", "node").distinct()
    shared = _sized(repeated, "doc_id").groupBy("doc_id").agg(F.min("node").alias("a"))
    shared = repeated.join(shared, "doc_id").select("a", F.col("node").alias("b"))
    joined = connected_components(links.unionAll(shared))
    firsts = joined.join(classes.select("node", "first"), "node")
    least = firsts.groupBy("component").agg(F.min("first").alias("component_id"))
    named = firsts.join(least, "component").select("node", "component_id")
    named = classes.select("node", "first").join(named, "node", "left").select(
        "node", F.coalesce("component_id", "first").alias("component_id")
    )
    out = signed.select("doc_id", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def without_near_duplicates(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", *, words: int = WORDS,
    similar: float = SIMILAR,
) -> DataFrame:
    """Rows of ``df`` without those whose component has a document with a smaller id.

    Rows without words and rows without an id stay. Of rows that repeat a kept id, the smallest by all
    columns stays. The columns are those of ``df``.
    """
    found = stored(
        near_duplicates(df, doc_id, text, words=words, similar=similar), "minhash-components"
    )
    (key,) = fresh(df, "key")
    dropped = found.filter("NOT kept").select(F.col("doc_id").alias(key)).distinct()
    left = df.join(dropped.hint("merge"), col(doc_id) == F.col(key), "left_anti")
    repeated = found.filter("kept AND n_shingles > 0 AND doc_id IS NOT NULL").groupBy(
        F.col("doc_id").alias(key)).agg(F.count("*").alias("n")).filter("n > 1").select(key)
    repeated = stored(repeated, "minhash-repeated")
    if repeated.isEmpty():
        return left
    row = F.struct(*[col(c) for c in df.columns])
    smallest = left.join(repeated, col(doc_id) == F.col(key), "left_semi").select(
        col(doc_id).alias(key), row.alias("row")).groupBy(key).agg(F.min("row").alias("row"))
    return left.join(repeated, col(doc_id) == F.col(key), "left_anti").unionByName(
        smallest.select("row.*")
    )
