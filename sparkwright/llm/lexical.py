"""Ranked lexical search: each query's best documents under an integer BM25-like score,
with documents grouped by the mask of query terms they hold.

Scoring, all in 64-bit integers but the weight (fixed by the contract of the query):
terms are maximal runs of ``TERM`` after A-Z is lower-cased; N counts the documents that
hold a term, L all their terms with repeats, n one document's terms, df the documents
holding a term, tf its count in one document.

    w = floor(1000 * ln((2N + 2) / (2 df + 1)))          (doubles)
    m = 50 + (50 n N) div L
    c(term, doc) = w * ((10**9 tf) div (1000 tf + 20 m))
    score(query, doc) = sum of c over the query's distinct terms

Method (presence masks, exact):

1. One scan counts each text's terms inside its own task (Arrow's RE2 split and group-by
   on bounded pieces of a batch), so only (row, term, tf) pairs leave it, never single
   occurrences, and only for terms that some query holds (the others change no score; N
   and L come from per-text totals). From them come the postings (row, term, c) and per term its df, w and the
   largest c of any document (its impact). Postings are written once, with a number for
   each term (``tid``), so that later joins compare longs; terms of weight 0 add nothing
   and are left out.
2. A query's terms are *rare* or *frequent* (df above ``1 / FREQUENT_SHARE`` of N). Rare
   postings are joined to the queries and summed. Each query's best ``SEEDS * k`` documents
   by that rare score are completed; theta, their k-th exact score, is at most the k-th
   final score.
3. A query's frequent terms are taken by rising impact: those whose impacts add up to at
   most ``SLACK_SHARE`` of theta are *slack*, the others *essential*. A document reaches
   theta only if its rare and essential terms give it theta less the impacts of the slack
   terms, so only the essential postings are summed, as they stream past the broadcast
   query terms, together with the rare scores. A query with fewer than k documents in
   step 2 has theta 0 and no slack terms, so its sums are its scores.
4. Each query's best ``SEEDS * k`` documents by that sum are completed for a larger theta,
   which the sums are held against once more.
5. The few documents that pass are completed: all their terms looked up, their matched
   terms become a bitmap (63 terms a long, ``bit_or``; a mask is named by the sum of its
   buckets' 64-bit hashes), documents are grouped by mask, and a mask whose bound (the sum
   of its terms' impacts) is below theta is never ranked.
   Documents are completed grouped by row, so each document's postings are read
   once for all its queries and one summed row per (query, document) is shuffled.

Skew: the query terms are broadcast to the postings when a count shows at most
``QUERY_BROADCAST`` of them; beyond, joins on a term are salted by row for terms with more
than ``SALT_ROWS`` postings, the query side repeated once per salt, so a term held by a
third of all documents is many tasks. Ranking uses Spark's per-group limit below the shuffle, so at most k rows per query
and task move. Nothing is collected but N and L.

Edge cases: a null or empty text has no terms and is in neither N nor L; a null query text
or a query without known terms has no rows; item rows of one id are one query (the union
of their terms), so a repeated item is answered once; document rows are documents, so a repeated row is ranked
twice (equal rows, equal scores); rows with a null doc_id count in the statistics but are
not returned; only score > 0 is returned; ties go to the smaller doc_id. Extra columns of
either table are ignored, also when their names clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkwright.session import scratch_path, ship_package

# Fixed values of the contract: the term pattern and the letters that are lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

FREQUENT_SHARE = 64
SALT_ROWS = 4096
#: Documents completed for each of a query's k places to find theta.
SEEDS = 4
#: Frequent terms that together give at most this share of theta are not summed before
#: the filter. A larger share sums fewer postings and completes more documents.
SLACK_SHARE = 0.6
#: Query terms are broadcast to the postings when they are at most this many rows.
QUERY_BROADCAST = 2_000_000


def terms_of(text: Column) -> Column:
    """All terms of a text, in order, with repeats; null gives an empty array."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), 0)


SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PIECE_BYTES = 8 << 20
#: The query vocabulary is sent to the tasks up to this many terms; beyond, a join filters.
VOCABULARY_BROADCAST = 1 << 20
TF_SCHEMA = "row long, doc_id long, n long, term string, tf long"


def _written(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """``df`` written below the shared scratch folder and read back, with its path."""
    path = scratch_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _kept(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written (zstd) and read back; it stays for the rest of the search."""
    return _written(df, tag)[0]


def _remove(spark, path: str) -> None:
    """Delete a written table once every table read later has been written from it, so
    that lost work re-reads its successors' files and never this one."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _pieces(batch: pa.RecordBatch):
    """Slices of a batch with at most PIECE_BYTES of text, a longer text alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > PIECE_BYTES:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


def term_counts(batches, vocabulary=None):
    """(row, doc_id, text) batches -> per text one row with term null and tf = n (its
    number of terms, texts without terms left out), and one row per distinct term that is
    in ``vocabulary`` (all terms if None) with its tf. All in Arrow kernels."""
    out = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()),
                     ("term", pa.string()), ("tf", pa.int64())])
    keep = None if vocabulary is None else pa.array(vocabulary, pa.string())
    for batch in batches:
        for piece in _pieces(batch):
            words = pc.split_pattern_regex(pc.ascii_lower(piece.column(2)), SEPARATORS)
            flat = pc.list_flatten(words)
            parent = pc.list_parent_indices(words)
            nonempty = pc.not_equal(pc.binary_length(flat), 0)
            flat, parent = pc.filter(flat, nonempty), pc.filter(parent, nonempty)
            n_of = np.bincount(parent.to_numpy(), minlength=piece.num_rows).astype(np.int64)
            texts = np.flatnonzero(n_of > 0)
            if len(texts):
                yield pa.RecordBatch.from_arrays(
                    [pc.take(piece.column(0), texts), pc.take(piece.column(1), texts), pa.array(n_of[texts]),
                     pa.nulls(len(texts), pa.string()), pa.array(n_of[texts])],
                    schema=out,
                )
            if keep is not None:
                wanted = pc.is_in(flat, value_set=keep)
                flat, parent = pc.filter(flat, wanted), pc.filter(parent, wanted)
            if len(flat) == 0:
                continue
            counts = pa.table({"p": parent, "term": flat}).group_by(["p", "term"]).aggregate([("term", "count")])
            p = counts.column("p").combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [
                    pc.take(piece.column(0), p),
                    pc.take(piece.column(1), p),
                    pa.array(n_of[p.to_numpy()]),
                    counts.column("term").combine_chunks(),
                    counts.column("term_count").cast(pa.int64()).combine_chunks(),
                ],
                schema=out,
            )


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: DataFrame | None = None):
    """Postings (row, doc_id, tid, c, salt) and term statistics (term, tid, df, w, impact),
    written; ``tid`` is the term's number in the statistics. A term's postings are dealt
    over ``df // SALT_ROWS + 1`` salts by row.

    Terms are counted inside each text's task; only (row, term) pairs are shuffled. With a
    ``vocabulary`` (one column ``term``) only its terms are indexed - N and L still count
    every term of every text; it is sent to the tasks when it has at most
    VOCABULARY_BROADCAST terms, else the pairs are filtered by a join."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
    )
    small = None
    if vocabulary is not None and vocabulary.count() <= VOCABULARY_BROADCAST:
        small = spark.sparkContext.broadcast([r[0] for r in vocabulary.select("term").collect()])
    counted = rows.mapInArrow(
        lambda b: term_counts(b, None if small is None else small.value), TF_SCHEMA
    )
    if vocabulary is not None and small is None:
        known = vocabulary.select("term", F.lit(True).alias("_known"))
        counted = counted.join(known, "term", "left").where(F.col("term").isNull() | F.col("_known")).drop("_known")
    tf, tf_path = _written(counted, "lexical-tf")
    totals = tf.where(F.col("term").isNull()).agg(F.count("*").alias("N"), F.sum("n").alias("L")).first()
    big_n, big_l = int(totals["N"] or 0), int(totals["L"] or 0)
    tf = tf.where(F.col("term").isNotNull())
    if big_n == 0:
        empty = spark.createDataFrame([], "row long, doc_id long, tid long, c long, salt int")
        return empty, spark.createDataFrame([], "term string, tid long, df long, w long, impact long"), 0
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    w = F.floor(
        F.lit(1000.0) * F.log((F.lit(2.0 * big_n + 2.0)) / (F.lit(2.0) * F.col("df") + F.lit(1.0)))
    ).cast("long")
    # The numbers are fixed by this write: all later joins read them from its files.
    weights, weights_path = _written(
        df.withColumn("w", w).where(F.col("w") > 0).withColumn("tid", F.monotonically_increasing_id()),
        "lexical-weights",
    )
    m = f"(50L + (50L * n * {big_n}L) div {big_l}L)"
    c = F.expr(f"w * ((1000000000L * tf) div (1000L * tf + 20L * {m}))")
    salts = (F.col("df") / SALT_ROWS).cast("int") + 1
    postings = (
        tf.join(weights, "term")
        .select(
            "row", "doc_id", "tid", c.alias("c"),
            F.pmod(F.xxhash64("row"), salts).cast("int").alias("salt"),
        )
        .where(F.col("c") > 0)
    )
    postings = _kept(postings, "lexical-postings")
    impact = postings.groupBy("tid").agg(F.max("c").alias("impact"))
    stats = _kept(weights.join(impact, "tid"), "lexical-terms")
    _remove(spark, tf_path)
    _remove(spark, weights_path)
    return postings, stats, big_n


def _salted_hits(queries: DataFrame, postings: DataFrame) -> DataFrame:
    """queries (item_id, tid, salts, ...) joined with postings (row, doc_id, tid, c, salt)
    on the term: the query row is repeated once per salt of its term."""
    q = queries.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    return q.join(postings, ["tid", "salt"]).drop("salt", "salts")


def _best(rows: DataFrame, k: int, *ties: str) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), *(ties or ("doc_id", "row")))
    return rows.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


def _kth(rows: DataFrame, k: int) -> DataFrame:
    """(item_id, kth, found): the k-th best score of each query's rows, 0 with fewer."""
    return (
        _best(rows, k)
        .groupBy("item_id")
        .agg(F.min("score").alias("low"), F.count("*").alias("found"))
        .select("item_id", F.when(F.col("found") >= k, F.col("low")).otherwise(F.lit(0)).alias("kth"), "found")
    )


def _complete(
    pairs: DataFrame, postings: DataFrame, terms: DataFrame, small: bool, few: bool = False
) -> DataFrame:
    """(item_id, row, doc_id, score, mask, bound) for every (item_id, row): the sum, the
    matched-term mask and the mask's bound over the query's ``terms`` (item_id, tid, bit,
    impact) that the row holds. Pairs are grouped by row first, so each document's postings
    are read once for all its queries, and only one aggregated row per pair is shuffled.
    ``few`` pairs are sent to the postings, others meet them by row."""
    by_row = pairs.groupBy("row").agg(F.collect_set("item_id").alias("items"))
    by_row = F.broadcast(by_row) if few else by_row
    hits = postings.select("row", "doc_id", "tid", "c").join(by_row, "row").select(
        "row", "doc_id", "tid", "c", F.explode("items").alias("item_id")
    )
    hits = hits.join(F.broadcast(terms) if small else terms, ["item_id", "tid"])
    bucket = F.floor(F.col("bit") / 63).alias("bucket")
    per_bucket = hits.groupBy("item_id", "row", "doc_id", bucket).agg(
        F.sum("c").alias("score"),
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 63 AS INT))")).alias("bitmap"),
        F.sum("impact").alias("bound"),
    )
    # The mask's name is the sum of its buckets' hashes: a plain hash aggregate. Two masks
    # of one name would share the larger bound, which is still a bound for both.
    return per_bucket.groupBy("item_id", "row", "doc_id").agg(
        F.sum("score").alias("score"),
        F.sum(F.xxhash64("bucket", "bitmap")).alias("mask"),
        F.sum("bound").alias("bound"),
    )


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    frequent_share: int = FREQUENT_SHARE,
    slack_share: float = SLACK_SHARE,
) -> DataFrame:
    """Each item's k best documents: (item_id, rank, doc_id, score). A term is frequent
    when df * frequent_share > N; the answer does not depend on it, nor on ``slack_share``
    (0 to below 1, see SLACK_SHARE), only the work."""
    spark = docs.sparkSession
    asked = items.select(
        F.col(item_id).cast("long").alias("item_id"), F.explode(terms_of(F.col(item_text))).alias("term")
    ).where(F.col("item_id").isNotNull()).distinct()
    asked = _kept(asked, "lexical-asked")
    postings, stats, big_n = index(docs, doc_id, doc_text, asked.select("term").distinct())
    if big_n == 0:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    # Rows without an id count in the statistics but are never ranked.
    postings = postings.where(F.col("doc_id").isNotNull())
    frequent = F.col("df") * frequent_share > big_n
    bits = Window.partitionBy("item_id").orderBy("term")
    query_terms = (
        asked.join(stats, "term")
        .withColumn("frequent", frequent)
        .withColumn("salts", (F.col("df") / SALT_ROWS).cast("int") + 1)
        .withColumn("bit", F.row_number().over(bits) - 1)
    )
    query_terms = _kept(query_terms, "lexical-queries")
    # The query terms are sent whole to the tasks only below a counted bound.
    small = query_terms.count() <= QUERY_BROADCAST

    def hits_of(terms: DataFrame) -> DataFrame:
        if small:
            return postings.join(F.broadcast(terms.drop("salts")), "tid")
        return _salted_hits(terms, postings.select("row", "doc_id", "tid", "c", "salt"))

    # Documents that hold a rare term of the query, and theta: the k-th exact score among
    # the best of them, at most the k-th final score.
    rare = hits_of(query_terms.where(~F.col("frequent")).select("item_id", "tid", "salts"))
    candidates = _kept(
        rare.groupBy("item_id", "row", "doc_id").agg(F.sum("c").alias("score")), "lexical-rare"
    )
    terms = query_terms.select("item_id", "tid", "bit", "impact")
    seeds = _kept(_best(candidates, SEEDS * k).select("item_id", "row"), "lexical-seeds")
    scored = _complete(seeds, postings, terms, small, seeds.count() <= QUERY_BROADCAST)
    theta = _kth(scored, k).select("item_id", "kth")

    # A document's final score is at most the sum of its rare and essential terms plus the
    # impacts of the query's slack terms: a document whose sum leaves more of theta than
    # those is out, and only the others are completed.
    rising = Window.partitionBy("item_id", "frequent").orderBy("impact", "term").rowsBetween(Window.unboundedPreceding, 0)
    slack = F.col("frequent") & (F.col("upto") <= F.col("kth") * slack_share)
    split = (
        query_terms.join(theta, "item_id", "left")
        .withColumn("kth", F.coalesce("kth", F.lit(0)))
        .withColumn("upto", F.sum("impact").over(rising))
        .withColumn("slack", F.when(slack, F.col("upto")).otherwise(F.lit(0)))
        .select("item_id", "tid", "salts", "frequent", "kth", "slack")
    )
    split = _kept(split, "lexical-split")
    needs = split.groupBy("item_id").agg(F.max("kth").alias("kth"), F.max("slack").alias("slack"))

    def passing(sums: DataFrame, needs: DataFrame) -> DataFrame:
        needs = needs.select("item_id", (F.col("kth") - F.col("slack")).alias("need"))
        return sums.join(F.broadcast(needs) if small else needs, "item_id").where(F.col("score") >= F.col("need"))

    essential = hits_of(
        split.where(F.col("frequent") & (F.col("slack") == 0)).select("item_id", "tid", "salts")
    ).select("item_id", "row", F.col("c").alias("score"))
    sums = (
        candidates.select("item_id", "row", "score").unionByName(essential)
        .groupBy("item_id", "row").agg(F.sum("score").alias("score"))
    )
    strong = _kept(passing(sums, needs).select("item_id", "row", "score"), "lexical-strong")
    # The best sums give a larger theta, and the sums are held against it once more.
    seeds = _kept(_best(strong, SEEDS * k, "row").select("item_id", "row"), "lexical-seeds")
    scored = _complete(seeds, postings, terms, small, seeds.count() <= QUERY_BROADCAST)
    larger = _kth(scored, k).select("item_id", F.col("kth").alias("larger"))
    needs = _kept(
        needs.join(larger, "item_id", "left")
        .select("item_id", F.greatest("kth", F.coalesce("larger", F.lit(0))).alias("kth"), "slack"),
        "lexical-needs",
    )

    # The documents that pass are grouped by their mask of matched terms, and a mask is
    # ranked only if its bound (the sum of its terms' impacts) reaches theta.
    passed = _kept(_complete(passing(strong, needs).select("item_id", "row"), postings, terms, small), "lexical-masks")
    masks = passed.groupBy("item_id", "mask").agg(F.max("bound").alias("bound"))
    taken = masks.join(needs, "item_id").where(F.col("bound") >= F.col("kth"))
    reached = passed.join(taken.select("item_id", "mask"), ["item_id", "mask"], "left_semi")
    ranked = _best(reached.where(F.col("score") > 0), k)
    return ranked.select("item_id", "rank", "doc_id", "score")
