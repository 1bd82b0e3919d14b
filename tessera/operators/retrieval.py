"""Lexical and vector retrieval: postings, BM25, cosine top-k, re-ranking, fusion and facets."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import fold, folded
from ..sources.writers import scratch_path, stored

K1, B = 1.2, 0.75


def terms(*columns: Column | str) -> Column:
    """Folded word tokens of the columns together; no stemming."""
    text = F.concat_ws(" ", *[F.col(c) if isinstance(c, str) else c for c in columns])
    return F.array_remove(F.split(fold(text), r"[^\p{L}\p{N}]+"), "")


def with_terms(df: DataFrame, columns: list[str], into: str = "terms") -> DataFrame:
    """df with its folded words stored in ``into``: where that is null or not there yet, so texts that change later keep
    the words they had until it is set to null."""
    made = terms(*columns)
    return df.withColumn(into, F.coalesce(F.col(into), made) if into in df.columns else made)


def postings(df: DataFrame, id_col: str, *columns: str) -> DataFrame:
    """(id, term, tf, dl): how often each document has each term, and how many terms it has in all indexed columns."""
    words = df.select(F.col(id_col).alias("id"), terms(*columns).alias("w"))
    exploded = words.select("id", F.size("w").alias("dl"), F.explode("w").alias("term"))
    return exploded.groupBy("id", "term").agg(F.count("*").alias("tf"), F.first("dl").alias("dl"))


def query_terms(query: str) -> list[str]:
    """A query's words, folded as texts are; anything but letters and digits parts them, so no query is a syntax error."""
    return list(dict.fromkeys(t for t in re.split(r"[^\w]+|_", folded(query)) if t))


class LexicalIndex:
    """Stored postings of a table's texts, kept up as rows are added, changed and removed.

    Postings lie by batch and bucket of their term, so a search reads the buckets of its terms alone. A table of sizes
    (id, dl, batch, turn, mark) is written last; what it doesn't name doesn't count, so a batch that failed midway is
    invisible and its rows come again. Of the rows of an id the one of the last turn holds: an earlier batch's
    postings of it are passed over, and a null dl says that it was removed. ``merge`` writes what holds as one
    batch of a new generation, which readers take once it is whole. One writer at a time is meant.
    """

    BUCKETS, TASK, PIECE = 64, 1 << 22, 1 << 26
    _SIZES = "id long, dl long, batch string, turn long, mark long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _generation(self) -> str:
        """The folder of the newest generation that is whole."""
        base = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = base.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in fs.listStatus(base)] if fs.exists(base) else []
        whole = [int(n.split("=")[1]) for n in names if n.startswith("whole=")]
        return f"{self.path}/generation={max(whole)}" if whole else f"{self.path}/generation=0"

    def _entries(self) -> DataFrame:
        """All rows of the newest generation's sizes."""
        try:
            return self.spark.read.schema(self._SIZES).parquet(f"{self._generation()}/sizes")
        except AnalysisException:  # nothing written yet
            return self.spark.createDataFrame([], self._SIZES)

    def sizes(self) -> DataFrame:
        """(id, dl, batch, mark) of the rows that hold."""
        last = self._entries().groupBy("id").agg(F.max_by(F.struct("dl", "batch", "mark"), "turn").alias("e"))
        return last.select("id", "e.*").where("dl is not null")

    def refresh(self, df: DataFrame, id_col: str, columns: list[str]) -> None:
        """Indexes the rows of df whose id isn't there, or whose columns have changed since. Null ids are left out; of rows
        that repeat an id one, the same at every run, counts."""
        rows = df.select(F.col(id_col).cast("long").alias("id"), *columns).where("id is not null").withColumn("_mark", F.xxhash64(*columns))
        one = rows.groupBy("id").agg(F.min(F.struct("_mark", *columns)).alias("r")).select("id", "r.*")
        self._add(one.join(self.sizes().select("id", F.col("mark").alias("_mark")), ["id", "_mark"], "left_anti"), columns)

    def _add(self, new: DataFrame, columns: list[str]) -> None:
        batch, turn, folder = uuid.uuid4().hex, self._next_turn(), self._generation()
        new = stored(new, "new-texts")
        size = new.agg(F.sum(F.length(F.concat_ws(" ", *columns)))).first()[0] or 0
        # an id is one row here, so dealt by id its words are counted where it is, some TASK characters at a time
        self._write_postings(postings(new.repartition(max(1, -(-size // self.TASK)), "id"), "id", *columns), folder, batch, size)
        sizes = new.select("id", F.size(terms(*columns)).cast("long").alias("dl"), F.lit(batch).alias("batch"), F.lit(turn).cast("long").alias("turn"), F.col("_mark").alias("mark"))
        sizes.write.mode("append").parquet(f"{folder}/sizes")

    def remove(self, ids: DataFrame, id_col: str) -> None:
        """Takes the rows of these ids out of the index; ids that aren't there change nothing."""
        gone = ids.select(F.col(id_col).cast("long").alias("id")).distinct().join(self.sizes().select("id"), "id", "left_semi")
        none = F.lit(None).cast("long")
        gone = gone.select("id", none.alias("dl"), F.lit(None).cast("string").alias("batch"), F.lit(self._next_turn()).cast("long").alias("turn"), none.alias("mark"))
        gone.write.mode("append").parquet(f"{self._generation()}/sizes")

    def _next_turn(self) -> int:
        return (self._entries().agg(F.max("turn")).first()[0] or 0) + 1

    def _write_postings(self, found: DataFrame, folder: str, batch: str, size: int) -> None:
        # a bucket's postings of some PIECE characters go to one task, which sorts them and writes one file
        pieces = max(1, -(-size // self.PIECE))
        counted = found.withColumns({"bucket": self._bucket(F.col("term")), "dl": F.col("dl").cast("int")}).repartition("bucket", F.pmod(F.xxhash64("id"), F.lit(pieces)))
        counted.sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{folder}/postings/batch={batch}")

    def merge(self) -> None:
        """Writes what holds as one batch of a new generation; older generations stay until they are deleted by hand."""
        held = self.sizes()
        before = self._generation()
        number, batch = int(before.split("=")[-1]) + 1, uuid.uuid4().hex
        folder = f"{self.path}/generation={number}"
        self._write_postings(self.postings(), folder, batch, 6 * (held.agg(F.sum("dl")).first()[0] or 0))
        held.select("id", "dl", F.lit(batch).alias("batch"), F.lit(1).cast("long").alias("turn"), "mark").write.mode("overwrite").parquet(f"{folder}/sizes")
        mark = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/whole={number}")
        mark.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).create(mark, False).close()

    def postings(self, wanted: list[str] | None = None) -> DataFrame:
        """(id, term, tf, dl) of the rows that hold, of the wanted terms if any; only their buckets are read."""
        entries = self._entries()
        batches = [r[0] for r in entries.where("batch is not null").select("batch").distinct().collect()]  # one a refresh; merge makes them one
        if not batches:
            return self.spark.createDataFrame([], "id long, term string, tf long, dl long")
        folder = f"{self._generation()}/postings"
        found = self.spark.read.option("basePath", folder).schema("id long, term string, tf long, dl int, batch string, bucket int").parquet(*[f"{folder}/batch={b}" for b in batches])
        if wanted is not None:
            buckets = [r[0] for r in self.spark.createDataFrame([(t,) for t in wanted], "t string").select(self._bucket(F.col("t"))).distinct().collect()] if wanted else []
            found = found.where(F.col("bucket").isin(buckets) & F.col("term").isin(wanted))
        # what changed or went since its batch
        stale = entries.select("id", "batch").where("batch is not null").join(self.sizes().select("id", "batch"), ["id", "batch"], "left_anti")
        return found.join(stale, ["id", "batch"], "left_anti").select("id", "term", "tf", F.col("dl").cast("long").alias("dl"))

    def _bucket(self, term: Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.BUCKETS)).cast("int")

    def search(self, queries: dict[str, str], k: int = 300) -> DataFrame:
        """(query_id, id, score, rank) of texts by query id."""
        asked = [(q, t) for q, text in queries.items() for t in query_terms(text)]
        wanted = self.spark.createDataFrame(asked, "query_id string, term string")
        return bm25_of_postings(self.postings(sorted({t for _, t in asked})), self.sizes().select("id", "dl"), wanted, k)


def bm25(df: DataFrame, id_col: str, columns: list[str], query: str, k: int = 300, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, score, *keep): the ``k`` best documents that have all of the query's words; smaller is better, ties (to nine
    places, so that the order of summing doesn't count) by id.

    Texts are read and cut into words once: one pass counts the query's words by document and is stored, and both the
    corpus statistics and the scores come from that. Use ``LexicalIndex`` where many queries follow.
    """
    wanted = query_terms(query)
    words = df.select(F.col(id_col).alias("id"), *keep, terms(*columns).alias("w"))
    counted = words.select("id", *keep, F.size("w").alias("dl"), *[_count("w", t).alias(f"tf{i}") for i, t in enumerate(wanted)])
    path = scratch_path(df.sparkSession, "counted")
    counted.write.parquet(path)
    counted = df.sparkSession.read.schema(counted.schema).parquet(path)
    stats = counted.agg(F.count("*").alias("n_docs"), F.avg("dl").alias("avgdl"), *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(wanted))])
    hits = counted.where(" and ".join(f"tf{i} > 0" for i in range(len(wanted))) or "false").join(F.broadcast(stats))  # stats is one row
    score = F.lit(0.0)
    for i in range(len(wanted)):
        score = score - _part(F.col(f"tf{i}"), F.col("dl"), F.col(f"df{i}"))
    return hits.select("id", F.round(score, 9).alias("score"), *keep).orderBy("score", "id").limit(k)


def _count(words: str, term: str) -> Column:
    return F.size(words) - F.size(F.array_remove(words, term))


def _part(tf: Column, dl: Column, df: Column) -> Column:
    idf = F.greatest(F.log((F.col("n_docs") - df + 0.5) / (df + 0.5)), F.lit(1e-6))
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / F.col("avgdl")))


def bm25_of_postings(index: DataFrame, sizes: DataFrame, queries: DataFrame, k: int = 300) -> DataFrame:
    """(query_id, id, score, rank) for many queries (query_id, term) over stored postings; sizes: (id, dl) of all documents."""
    stats = sizes.agg(F.count("*").alias("n_docs"), F.avg("dl").alias("avgdl"))
    wanted = queries.select("query_id", "term").distinct()
    df = index.join(wanted.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.count("*").alias("df"))
    need = wanted.groupBy("query_id").agg(F.count("*").alias("need"))
    hits = wanted.join(index, "term").join(df, "term").join(F.broadcast(stats))  # one row
    scored = hits.groupBy("query_id", "id").agg(F.round(-F.sum(_part(F.col("tf"), F.col("dl"), F.col("df"))), 9).alias("score"), F.count("*").alias("have"))
    scored = scored.join(need, "query_id").where("have = need")
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))).where(F.col("rank") <= k).select("query_id", "id", "score", "rank")


#: Vectors in a block, blocks that one task goes through for a block of queries, and queries in a block.
VECTOR_BLOCK, TOGETHER, QUERY_BLOCK = 4096, 16, 2048


def cosine_topk(vectors: DataFrame, queries: DataFrame, id_col: str, vector_col: str, k: int = 300) -> DataFrame:
    """(query_id, id, score, rank): for each row of ``queries`` the ``k`` most similar other rows of ``vectors``; ties by id.

    Both sides are packed into blocks by length. A block of queries meets a shard of ``TOGETHER`` blocks of vectors in one task, which
    multiplies in double precision and keeps the best k a query, so k rows a query and shard are shuffled to the
    ranking, and neither side passes through the driver. Vectors of other lengths than a query's aren't compared with
    it; null and empty vectors, and those with null or non-finite components, have no similarity.
    """
    base, asked = _packed_vectors(vectors, id_col, vector_col, VECTOR_BLOCK), _packed_vectors(queries, id_col, vector_col, QUERY_BLOCK)
    shards = base.groupBy("dim").agg(F.floor(F.max("block") / TOGETHER).alias("last"))
    turns = asked.groupBy("dim").agg(F.max("block").alias("last"))
    one = asked.join(shards, "dim").select("dim", F.col("block").alias("turn"), F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("shard"), F.lit(True).alias("asks"), "ids", "values")
    two = base.join(turns, "dim").select("dim", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("turn"), F.floor(F.col("block") / TOGETHER).alias("shard"), F.lit(False).alias("asks"), "ids", "values")
    best = one.unionByName(two).groupBy("dim", "turn", "shard").applyInArrow(_best(k), "query_id long, id long, score double")
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))).where(F.col("rank") <= k)


def _packed_vectors(df: DataFrame, id_col: str, vector_col: str, block: int) -> DataFrame:
    """(dim, block, ids, values): the usable vectors of a length, some ``block`` in a row."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where("id is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('inf'))").withColumn("dim", F.size("v"))
    blocks = rows.groupBy("dim").agg(F.ceil(F.count("*") / block).alias("blocks"))
    placed = rows.join(F.broadcast(blocks), "dim") if blocks.count() <= 1000 else rows.join(blocks, "dim")  # lengths are few
    placed = placed.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks"))).drop("blocks")

    def pack(table: pa.Table) -> pa.Table:
        values = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return pa.table({"dim": table.column("dim").slice(0, 1), "block": table.column("block").slice(0, 1), "ids": [table.column("id").to_numpy().tobytes()], "values": [values.tobytes()]})

    return placed.groupBy("dim", "block").applyInArrow(pack, "dim int, block long, ids binary, values binary")


def _best(k: int):
    def run(table: pa.Table) -> pa.Table:
        sides: dict[bool, list[tuple[np.ndarray, np.ndarray]]] = {True: [], False: []}
        for row in table.to_pylist():
            x = np.frombuffer(row["values"], np.float64).reshape(-1, row["dim"])
            sides[row["asks"]].append((np.frombuffer(row["ids"], np.int64), x / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-12)))
        ids, asked = sides[True][0]
        best = np.full((len(ids), 0), -np.inf)
        names = np.zeros((len(ids), 0), np.int64)
        for other, x in sides[False]:
            score = asked @ x.T
            score[ids[:, None] == other[None]] = -np.inf
            score, name = np.concatenate([best, score], axis=1), np.concatenate([names, np.broadcast_to(other, score.shape)], axis=1)
            order = np.lexsort((name, -score), axis=1)[:, :k]
            best, names = np.take_along_axis(score, order, axis=1), np.take_along_axis(name, order, axis=1)
        real = best > -np.inf
        return pa.table({"query_id": np.repeat(ids, best.shape[1])[real.ravel()], "id": names[real], "score": best[real]})

    return run


def rerank(hits: DataFrame, scorer: Callable[[DataFrame], DataFrame] | None = None, k: int = 100) -> DataFrame:
    """The best ``k`` of each query after a second scorer (which sets ``score``); without one the first score stands."""
    again = scorer(hits) if scorer else hits
    return again.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))).where(F.col("rank") <= k)


def reciprocal_rank_fusion(*rankings: DataFrame, k: int = 60, top: int = 100) -> DataFrame:
    """(query_id, id, score, rank) of rankings (query_id, id, rank) joined by summed 1 / (k + rank)."""
    both = None
    for r in rankings:
        r = r.select("query_id", "id", (F.lit(1.0) / (F.lit(k) + F.col("rank"))).alias("s"))
        both = r if both is None else both.unionByName(r)
    fused = both.groupBy("query_id", "id").agg(F.sum("s").alias("score"))
    return fused.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))).where(F.col("rank") <= top)


def facets(hits: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """(value, n) over results, most frequent first."""
    out = hits.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value")
    return out.limit(top) if top else out


def preview(titulo: Column, rubro: Column, text: Column) -> tuple[Column, Column]:
    return F.substring(F.coalesce(F.nullif(titulo, F.lit("")), rubro), 1, 80), F.translate(F.substring(text, 1, 120), "\n", " ")


def embed_pending(chunks: DataFrame, embed: Callable[[Column], Column], model: str, text: str = "text", embedding: str = "embedding", types: list[str] | None = None) -> DataFrame:
    """All chunks, with vectors for those that have none yet: ``embedding``, ``embedding_model`` and ``embedded_at`` are
    set where a chunk was pending, and only its text is embedded. Write the result as the new table."""
    todo = pending_embeddings(chunks, embedding, types)
    fits = F.col(embedding).isNull() & (F.col("chunk_type").isin(types) if types else F.lit(True))
    rest = chunks.where(~F.coalesce(fits, F.lit(False)))
    done = todo.withColumns({embedding: embed(F.col(text)), "embedding_model": F.lit(model), "embedded_at": F.current_timestamp()})
    return rest.unionByName(done.select(*rest.columns))


def pending_embeddings(chunks: DataFrame, embedding: str = "embedding", types: list[str] | None = None) -> DataFrame:
    """Chunks without a vector, of the given types; embed them with functions.vectors.hash_embed or a service's UDF."""
    out = chunks.where(F.col(embedding).isNull())
    return out.where(F.col("chunk_type").isin(types)) if types else out
