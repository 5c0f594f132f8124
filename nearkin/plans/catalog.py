"""The registered queries: every operator bound to the shared test tables.

Bindings: ``documents`` is the corpus; documents ``2k`` and ``2k + 1`` form pair ``k``, labelled
by whether their quality labels agree; ``embeddings`` are the vectors, linked to documents and
benchmark items by id; ``events`` is the request and click log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearkin.functions import text as tx
from nearkin.functions.encoders import hashed_encoder, overlap_scorer
from nearkin.functions.similarity import fuzzy_features, jaccard, length_features, overlap_features
from nearkin.functions.vectors import cosine, l2_normalize
from nearkin.operators import (
    bm25, boosting, classification, corpus, explore, features, fusion, maintain, quality, ranking, requests,
    retrieval, splits, tfidf, vectors,
)
from nearkin.plans import evaluation, prepare, search, training
from nearkin.schemas import FEATURES
from nearkin.session import materialize, scratch_path, small_batches, spread
from nearkin.sources import segments, tables
from nearkin.streaming import batches, ingest, monitoring, reuse

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

BOOST_BINS = 16
NATIVE_FEATURES = [f for f in FEATURES if f.startswith(("len_", "common_"))]
REUSE_THRESHOLD = 0.35
NEW_ID_BASE = 1_000_000_000


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# --- bindings ---------------------------------------------------------------------------------

def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """``question_id, question_text``"""
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("question_id"), F.col("text").alias("question_text"))
    return spread(docs, "question_id")


def raw_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Flat layout ``idx, question1, question2, label``; the label is null where unknown."""
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    side = docs.select(F.expr("doc_id div 2").alias("idx"), (F.col("doc_id") % 2).alias("side"), "text", "quality")
    first = side.filter("side = 0").select("idx", F.col("text").alias("question1"), F.col("quality").alias("quality1"))
    second = side.filter("side = 1").select("idx", F.col("text").alias("question2"), F.col("quality").alias("quality2"))
    return first.join(second, "idx").select(
        "idx", "question1", "question2", (F.col("quality1") == F.col("quality2")).cast("int").alias("label"))


def pairs_of(spark: SparkSession, sf: str) -> DataFrame:
    """``pair_id`` and the pair columns."""
    return corpus.build_pairs(corpus.normalize_pairs(raw_pairs(spark, sf))).withColumn(
        "pair_id", F.expr("qid1 div 2"))


def labelled_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Only the pairs whose label is known."""
    known = raw_pairs(spark, sf).filter(F.col("label").isNotNull())
    return corpus.build_pairs(corpus.normalize_pairs(known)).withColumn("pair_id", F.expr("qid1 div 2"))


def split_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return splits.hash_split(pairs_of(spark, sf), "pair_id")


def vectors_of(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


def vector_queries(spark: SparkSession, sf: str) -> DataFrame:
    return vectors_of(spark, sf).select(F.col("id").alias("query_id"), F.col("embedding").alias("query_embedding"))


def benchmark_queries(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))


def stored_vectors(spark: SparkSession, sf: str) -> vectors.VectorIndex:
    return vectors.build_vector_index(vectors_of(spark, sf))


def request_log(events: DataFrame) -> DataFrame:
    """Events read as requests: errors fail, clicks come from the cache, the value is the latency."""
    kind = F.col("event_type")
    return events.select(
        "ts", F.when(kind == "error", 500).otherwise(200).alias("status"), F.col("value").alias("latency_ms"),
        (kind == "click").alias("was_cached"))


def feedback_events(events: DataFrame) -> DataFrame:
    """Events read as feedback: the user is the question, clicks are relevant, small values rate."""
    return events.select(
        F.col("event_type").alias("query"), F.col("user_id").alias("retrieved_question_id"),
        (F.col("event_type") == "click").alias("is_relevant"),
        F.when(F.col("value") < 10, F.floor("value").cast("int")).alias("user_rating"))


def scored_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents scored by the share of distinct words."""
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    words = tx.words(F.lower("text"))
    share = F.coalesce(F.try_divide(F.size(F.array_distinct(words)).cast("double"), F.size(words)), F.lit(0.0))
    return docs.join(table(spark, sf, "labels"), "doc_id").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("y_true"), F.round(share, 4).alias("y_prob"))


def scored_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled pairs scored by word overlap."""
    return labelled_pairs(spark, sf).select(
        F.col("pair_id").alias("id"), "question1", "question2", F.col("is_duplicate").alias("y_true"),
        F.round(jaccard(F.col("question1"), F.col("question2")), 6).alias("y_prob"))


def candidates_of(spark: SparkSession, sf: str) -> DataFrame:
    """Vector neighbours of every vector with the texts of both documents."""
    docs = documents(spark, sf)
    found = vectors.knn_exact(vector_queries(spark, sf), vectors_of(spark, sf), 10)
    texts = docs.select(F.col("question_id").alias("query_id"), F.col("question_text").alias("query_text"))
    return vectors.attach_questions(found, docs).join(texts, "query_id")


def stream_of(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table as a stream, whether it is one file or a folder of part files.

    A stream takes no single file as its path, but a pattern that matches one; ``pathGlobFilter`` would look at
    the names of the part files.
    """
    schema = table(spark, sf, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{{{name}}}.parquet")


def plain_time(df: DataFrame, name: str = "window_start") -> DataFrame:
    """Time stamps without a zone, as the input tables have them."""
    return df.withColumn(name, F.col(name).cast("timestamp_ntz"))


# --- pairs and corpus -------------------------------------------------------------------------

@query
def flatten_pairs(spark, sf):
    return corpus.build_pairs(corpus.normalize_pairs(raw_pairs(spark, sf)))


@query
def flatten_pairs_nested(spark, sf):
    nested = raw_pairs(spark, sf).select(
        F.col("idx").alias("row_index"),
        F.struct(F.array(F.col("idx") * 2, F.col("idx") * 2 + 1).alias("id"),
                 F.array("question1", "question2").alias("text")).alias("questions"),
        (F.col("label") == 1).alias("is_duplicate"))
    return corpus.build_pairs(corpus.normalize_pairs(nested))


@query
def corpus_dedupe(spark, sf):
    return corpus.build_corpus(corpus.normalize_pairs(raw_pairs(spark, sf)))


@query
def corpus_size(spark, sf):
    return corpus_dedupe(spark, sf).agg(F.count("*").alias("n_questions"))


@query
def canonical_pairs(spark, sf):
    normalized = corpus.normalize_pairs(raw_pairs(spark, sf))
    return corpus.canonicalize_ids(corpus.build_pairs(normalized), corpus.build_corpus(normalized)).select(
        "qid1", "qid2", "is_duplicate")


@query
def truth_table(spark, sf):
    return corpus.truth_from_pairs(pairs_of(spark, sf))


@query
def clean_classical(spark, sf):
    return documents(spark, sf).select("question_id", tx.clean_classical(F.col("question_text")).alias("cleaned"))


@query
def clean_transformer(spark, sf):
    return corpus.clean_corpus(documents(spark, sf)).select("question_id", "question_clean")


@query
def clean_pairs(spark, sf):
    return corpus.clean_pairs(pairs_of(spark, sf)).select(
        "qid1", "qid2", "q1_classical", "q2_classical", "q1_transformer", "q2_transformer")


@query
def html_strip_pages(spark, sf):
    pages = spread(table(spark, sf, "pages"), "page_id")
    return pages.select("page_id", tx.remove_html(F.col("html")).alias("plain"))


@query
def clean_pages_classical(spark, sf):
    pages = spread(table(spark, sf, "pages"), "page_id")
    return pages.select("page_id", tx.clean_classical(F.concat_ws(" ", "url", "html")).alias("cleaned"))


@query
def prepared_splits(spark, sf):
    done = prepare.prepare(raw_pairs(spark, sf))
    return done.splits.groupBy("split").agg(F.count("*").alias("n"), F.sum("is_duplicate").alias("n_positive"))


@query
def training_examples(spark, sf):
    return corpus.training_examples(pairs_of(spark, sf), "question1", "question2")


# --- splits, samples, ids ---------------------------------------------------------------------

@query
def hash_split(spark, sf):
    return split_pairs(spark, sf).select("pair_id", "split")


@query
def stratified_split(spark, sf):
    return splits.stratified_split(pairs_of(spark, sf), "pair_id").select("pair_id", "is_duplicate", "split")


@query
def seeded_sample(spark, sf):
    return ranking.seeded_sample(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), 1000, "doc_id")


@query
def inspection_sample(spark, sf):
    return quality.inspection_sample(pairs_of(spark, sf).select("pair_id", "question1", "question2", "is_duplicate"), "pair_id")


@query
def dense_ids(spark, sf):
    return ranking.dense_index(table(spark, sf, "documents").select("doc_id", "n_chars"), ["n_chars", "doc_id"])


# --- pair features ----------------------------------------------------------------------------

def _columns(spark, sf, built: dict) -> DataFrame:
    return pairs_of(spark, sf).select("pair_id", *[c.alias(n) for n, c in built.items()])


@query
def length_feature_table(spark, sf):
    return _columns(spark, sf, length_features(F.col("question1"), F.col("question2")))


@query
def overlap_feature_table(spark, sf):
    built = overlap_features(F.col("question1"), F.col("question2"))
    built["common_word_ratio"] = F.round(built["common_word_ratio"], 6)
    return _columns(spark, sf, built)


@query
def fuzzy_feature_table(spark, sf):
    return fuzzy_features(pairs_of(spark, sf), "question1", "question2").select("pair_id", *FEATURES[:3])


@query
def tfidf_vocabulary(spark, sf):
    train = split_pairs(spark, sf).filter(F.col("split") == "train")
    return tfidf.fit_tfidf(train, "question1", "question2").vocabulary.select("term", F.round("idf", 6).alias("idf"))


@query
def tfidf_pair_cosine(spark, sf):
    pairs = materialize(split_pairs(spark, sf), "pairs")
    model = tfidf.fit_tfidf(pairs.filter(F.col("split") == "train"), "question1", "question2")
    scored = tfidf.tfidf_cosine(pairs, "pair_id", "question1", "question2", model)
    return scored.select("pair_id", F.round("tfidf_cosine", 6).alias("tfidf_cosine"))


@query
def word_vector_cosine(spark, sf):
    """The n most frequent words take the n vectors, in order."""
    counted = documents(spark, sf).select(F.explode(tx.term_counts(tx.words(F.lower("question_text")))).alias("t")).groupBy(
        F.col("t.term").alias("word")).agg(F.sum("t.tf").alias("cf"))
    n = vectors_of(spark, sf).count()
    chosen = ranking.top_n_by_count(materialize(counted, "words"), "cf", n, "word")
    placed = ranking.dense_index(chosen, [F.desc("cf"), "word"], "id")
    word_vectors = placed.join(vectors_of(spark, sf), "id").select("word", F.col("embedding").alias("vector"))
    scored = features.word_vector_cosine(pairs_of(spark, sf), "pair_id", "question1", "question2", word_vectors)
    return scored.select("pair_id", F.round("wv_cosine_similarity", 6).alias("wv_cosine_similarity"))


def feature_rows(pairs: DataFrame) -> DataFrame:
    """All features of ``pairs`` with their split and label, TF-IDF fitted on the training split."""
    cleaned = materialize(corpus.apply_cleaning(pairs, "classical"), "cleaned")
    model = tfidf.fit_tfidf(cleaned.filter(F.col("split") == "train"), "q1_classical", "q2_classical")
    return features.build_features(cleaned, "pair_id", tfidf=model, keep=("is_duplicate",))


@query
def feature_table(spark, sf):
    return feature_rows(split_pairs(spark, sf))


@query
def feature_correlations_all(spark, sf):
    """All features of the cleaned labelled pairs against the label, with p-values."""
    table_ = feature_rows(splits.hash_split(labelled_pairs(spark, sf), "pair_id"))
    found = features.feature_label_correlations(table_, "is_duplicate", list(FEATURES))
    return found.select("feature", "n", F.round("r", 6).alias("r"), "p_value", "weak")


@query
def feature_correlations(spark, sf):
    """The features that SQL can express, on the texts as they are; ``feature_correlations_all`` has all."""
    pairs = labelled_pairs(spark, sf)
    a, b = F.col("question1"), F.col("question2")
    table_ = pairs.withColumns({**length_features(a, b), **overlap_features(a, b)})
    found = features.feature_label_correlations(table_, "is_duplicate", NATIVE_FEATURES)
    return found.select("feature", "n", F.round("r", 6).alias("r"), "weak")


# --- keyword search and fusion ----------------------------------------------------------------

@query
def bm25_postings(spark, sf):
    return bm25.build_index(documents(spark, sf)).postings


@query
def bm25_terms(spark, sf):
    index = bm25.build_index(documents(spark, sf))
    n = index.stats.select("n").scalar()
    return index.terms.select(
        "term", "df", F.round(F.log((n - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1.0), 6).alias("idf"))


@query
def bm25_search(spark, sf):
    return bm25.search(bm25.build_index(documents(spark, sf)), benchmark_queries(spark, sf), 10)


@query
def bm25_search_turns(spark, sf):
    turns = table(spark, sf, "conversations").filter(F.col("role") == "user").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), F.col("text").alias("query_text"))
    return bm25.search(bm25.build_index(documents(spark, sf)), turns, 10)


@query
def bm25_search_stored(spark, sf):
    """The same search on an index that went through storage."""
    path = scratch_path(spark, "bm25")
    bm25.build_index(documents(spark, sf)).save(path)
    return bm25.search(bm25.Bm25Index.load(spark, path), benchmark_queries(spark, sf), 10)


def _linked_queries(spark, sf) -> DataFrame:
    return benchmark_queries(spark, sf).join(vector_queries(spark, sf), "query_id")


def _grown_keywords(spark: SparkSession, sf: str) -> str:
    """A keyword index grown by three batches, whose live rows are the documents.

    With the first come doubled texts of what the second replaces, and benchmark items that the third deletes.
    """
    root = scratch_path(spark, "segments")
    docs = documents(spark, sf).withColumn("question_text", F.coalesce("question_text", F.lit("")))
    third = F.pmod(F.xxhash64("question_id"), F.lit(3))
    stale = docs.filter(third == 1).withColumn("question_text", F.concat_ws(" ", "question_text", "question_text"))
    extra = table(spark, sf, "benchmark").select((F.col("item_id") + NEW_ID_BASE).alias("question_id"), F.col("text").alias("question_text"))
    gone = extra.withColumn("question_text", F.lit(None).cast("string"))
    for number, batch in enumerate((
            docs.filter(third == 0).unionByName(stale).unionByName(extra), docs.filter(third == 1), docs.filter(third == 2).unionByName(gone))):
        segments.append(batch, number, root)
    return root


@query
def bm25_search_segments(spark, sf):
    """Keyword search over segments with replaced and deleted rows equals that over the documents."""
    return bm25.search(segments.load(spark, _grown_keywords(spark, sf)), benchmark_queries(spark, sf), 10)


@query
def bm25_search_merged(spark, sf):
    """The same after the segments were merged; the segments, their live rows and those written come with the hits."""
    root = _grown_keywords(spark, sf)
    segments.merge(spark, root, list(segments.read_state(spark, root).segments))
    state = segments.read_state(spark, root)
    hits = bm25.search(segments.load(spark, root), benchmark_queries(spark, sf), 10)
    return hits.withColumns({
        "segments": F.lit(len(state.segments)), "live_rows": F.lit(state.segments[0].n), "written_rows": F.lit(state.segments[0].written)})


@query
def rrf_fusion(spark, sf):
    linked = _linked_queries(spark, sf)
    dense = vectors.knn_exact(linked, vectors_of(spark, sf), 10)
    own = vectors.knn_exact(linked.select("query_id", F.transform("query_embedding", lambda x: -x).alias("query_embedding")),
                            vectors_of(spark, sf), 10)
    return fusion.reciprocal_rank_fusion([dense, own])


@query
def hybrid_search(spark, sf):
    return search.hybrid_search(_linked_queries(spark, sf), stored_vectors(spark, sf), bm25.build_index(documents(spark, sf)))


# --- vectors ----------------------------------------------------------------------------------

@query
def knn_exact(spark, sf):
    return vectors.knn_exact(vector_queries(spark, sf), vectors_of(spark, sf), 10)


@query
def knn_clustered_full_probe(spark, sf):
    index = vectors.build_vector_index(vectors_of(spark, sf))
    return vectors.knn_clustered(vector_queries(spark, sf), index, 10, probe=vectors.MAX_CELLS)


@query
def knn_clustered(spark, sf):
    """The approximate search: exact only where there are no more cells than probes."""
    return _approximate(spark, sf)[0]


def _approximate(spark, sf, cells: int | None = None) -> tuple[DataFrame, int, int]:
    """Hits of the approximate search, the number of cells and how many of them are probed."""
    index = vectors.build_vector_index(vectors_of(spark, sf), cells)
    n_cells = index.centroids.count()
    probe = vectors.probe_count(n_cells)
    return vectors.knn_clustered(vector_queries(spark, sf), index, 10, probe=probe), n_cells, probe


def neighbours_found(spark, sf, cells: int | None = None) -> DataFrame:
    """``n_exact, recall_at_10``: the share of the exact neighbours that the approximate search finds."""
    found = _approximate(spark, sf, cells)[0].select("query_id", "question_id", F.lit(1).alias("hit"))
    exact = knn_exact(spark, sf).select("query_id", "question_id")
    return exact.join(found, ["query_id", "question_id"], "left").agg(
        F.count("*").alias("n_exact"), F.round(F.count("hit") / F.count("*"), 4).alias("recall_at_10"))


@query
def knn_clustered_recall(spark, sf):
    return neighbours_found(spark, sf)


@query
def knn_small_cells_recall(spark, sf):
    """Whether the approximate search finds nine of ten neighbours where it leaves out cells: cells of three vectors."""
    n_cells = vectors_of(spark, sf).count() // 3
    found = neighbours_found(spark, sf, n_cells)
    return found.select("n_exact", (F.lit(vectors.probe_count(n_cells)) < n_cells).alias("cells_left_out"),
                        (F.col("recall_at_10") >= 0.9).alias("enough"))


@query
def self_retrieval(spark, sf):
    found = vectors_of(spark, sf)
    return vectors.self_retrieval(found, vectors.build_vector_index(found))


@query
def find_similar(spark, sf):
    docs = documents(spark, sf)
    queries = _linked_queries(spark, sf)
    return search.find_similar(queries, stored_vectors(spark, sf), docs, 5, 0.3).drop("question_text")


@query
def find_similar_responses(spark, sf):
    docs = documents(spark, sf)
    queries = _linked_queries(spark, sf)
    hits = search.find_similar(queries, stored_vectors(spark, sf), docs, 5, 0.35)
    return search.responses(queries, hits).select("query_id", "query_text", "result_count")


def _own_limits(spark, sf) -> DataFrame:
    """Requests with limits of their own."""
    return _linked_queries(spark, sf).withColumns({
        "top_k": (F.col("query_id") % 20 + 1).cast("int"), "score_threshold": F.col("query_id") % 5 / 10.0})


@query
def find_similar_requests(spark, sf):
    found = search.find_similar_requests(_own_limits(spark, sf), stored_vectors(spark, sf), documents(spark, sf))
    return found.drop("question_text")


@query
def find_similar_requests_rerank(spark, sf):
    found = search.find_similar_requests(_own_limits(spark, sf), stored_vectors(spark, sf), documents(spark, sf), overlap_scorer)
    return found.drop("question_text")


@query
def rerank_overlap(spark, sf):
    return fusion.rerank(candidates_of(spark, sf), overlap_scorer, 5).select("query_id", "rank", "question_id", "score")


@query
def compare_rerank(spark, sf):
    return search.compare_rerank(candidates_of(spark, sf), overlap_scorer)


@query
def pair_cosine(spark, sf):
    side = vectors_of(spark, sf).select(F.expr("id div 2").alias("pair_id"), (F.col("id") % 2).alias("side"), "embedding")
    first = side.filter("side = 0").select("pair_id", F.col("embedding").alias("a"))
    second = side.filter("side = 1").select("pair_id", F.col("embedding").alias("b"))
    return first.join(second, "pair_id").select("pair_id", F.round(cosine(F.col("a"), F.col("b")), 6).alias("cosine"))


@query
def l2_normalized(spark, sf):
    stretched = table(spark, sf, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: (x * (F.col("label") + 2)).cast("float")).alias("v"))
    return stretched.select("vec_id", F.posexplode(l2_normalize(F.col("v"))).alias("pos", "x")).select(
        "vec_id", "pos", F.round("x", 6).alias("x"))


@query
def norm_check(spark, sf):
    return vectors.norm_report(vectors_of(spark, sf)).select("n_vectors", "all_unit")


@query
def corpus_centroid(spark, sf):
    return vectors.corpus_centroid(vectors_of(spark, sf)).select(F.posexplode("centroid").alias("pos", "x")).select(
        "pos", F.round("x", 6).alias("x"))


@query
def cell_assignment(spark, sf):
    """Vectors go to the nearest of the label means."""
    labelled = table(spark, sf, "embeddings")
    means = (
        labelled.select("label", F.posexplode("embedding").alias("pos", "x")).groupBy("label", "pos")
        .agg(F.avg("x").alias("x")).groupBy("label")
        # one entry per dimension
        .agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("m"))
        .select(F.col("label").alias("cell"), l2_normalize(F.col("m.x")).alias("centroid"))
    )
    return vectors.assign_cells(vectors_of(spark, sf), means).select("id", "cell")


# --- evaluation -------------------------------------------------------------------------------

@query
def confusion_counts(spark, sf):
    return classification.confusion_counts(scored_documents(spark, sf))


@query
def class_report(spark, sf):
    return classification.class_report(scored_documents(spark, sf))


@query
def classifier_metrics(spark, sf):
    return classification.evaluate_classifier(scored_documents(spark, sf))


@query
def threshold_curve(spark, sf):
    curve = classification.score_curve(scored_documents(spark, sf))
    return classification.roc_pr_points(curve).select(
        "threshold", *[F.round(c, 6).alias(c) for c in ("fpr", "tpr", "precision", "recall")])


@query
def best_threshold(spark, sf):
    return classification.best_threshold(classification.score_curve(scored_documents(spark, sf)))


@query
def slice_metrics(spark, sf):
    return evaluation.slice_metrics(scored_pairs(spark, sf), threshold=0.01)


@query
def split_gap(spark, sf):
    scored = splits.hash_split(scored_documents(spark, sf), "id")
    return evaluation.split_gap(scored, right="test")


@query
def top_errors(spark, sf):
    return classification.top_errors(scored_pairs(spark, sf), 0.01, 10).select(
        "error_type", "rank", "id", "y_true", "y_prob")


@query
def errors_at_best_threshold(spark, sf):
    return evaluation.errors_at_best_threshold(scored_pairs(spark, sf)).select(
        "error_type", "rank", "id", "y_true", "y_prob", "threshold")


@query
def deep_evaluation(spark, sf):
    """The whole report: overall metrics, slices and errors of the scored test pairs, gap to validation, retrieval of all pairs."""
    scored = materialize(splits.hash_split(scored_pairs(spark, sf), "id"), "scored")
    return evaluation.report_rows(evaluation.deep_evaluation(scored, "id", 0.01, retrieval=retrieval_quality(spark, sf)))


@query
def class_weights(spark, sf):
    weights = classification.class_weights(labelled_pairs(spark, sf))
    return weights.select("n_neg", "n_pos", *[
        F.round(c, 6).alias(c) for c in ("positive_weight", "balanced_neg", "balanced_pos")])


@query
def golden_accuracy(spark, sf):
    vecs = vectors_of(spark, sf)
    a = vecs.select(F.col("id").alias("qid1"), F.col("embedding").alias("a"))
    b = vecs.select(F.col("id").alias("qid2"), F.col("embedding").alias("b"))
    lang = table(spark, sf, "documents").select(F.col("doc_id").alias("qid1"), F.col("lang").alias("category"))
    scored = pairs_of(spark, sf).join(a, "qid1").join(b, "qid2").join(lang, "qid1").select(
        "category", F.col("is_duplicate").alias("label"), cosine(F.col("a"), F.col("b")).alias("similarity"))
    return classification.golden_accuracy(scored)


@query
def pair_cosine_threshold(spark, sf):
    """Best threshold of the vector cosine on the labelled pairs that have vectors."""
    vecs = vectors_of(spark, sf)
    a = vecs.select(F.col("id").alias("qid1"), F.col("embedding").alias("a"))
    b = vecs.select(F.col("id").alias("qid2"), F.col("embedding").alias("b"))
    scored = labelled_pairs(spark, sf).join(a, "qid1").join(b, "qid2").select(
        F.col("is_duplicate").alias("y_true"), F.round(cosine(F.col("a"), F.col("b")), 6).alias("y_prob"))
    return classification.best_threshold(classification.score_curve(scored))


@query
def retrieval_quality(spark, sf):
    questions = documents(spark, sf).join(
        vectors_of(spark, sf).select(F.col("id").alias("question_id"), F.col("id").alias("vec_id")), "question_id", "left")
    return evaluation.retrieval_quality(pairs_of(spark, sf), questions, stored_vectors(spark, sf), n=None)


@query
def retrieval_by_label(spark, sf):
    """A neighbour of the same label is relevant; only retrieved rows need to be judged."""
    queries = vector_queries(spark, sf)
    found = vectors.knn_exact(queries, vectors_of(spark, sf), 10, skip_self=True)
    labels = table(spark, sf, "embeddings").select("vec_id", "label")
    own = labels.select(F.col("vec_id").alias("query_id"), F.col("label").alias("own"))
    theirs = labels.select(F.col("vec_id").alias("question_id"), F.col("label").alias("theirs"))
    truth = found.join(own, "query_id").join(theirs, "question_id").filter("own = theirs").select(
        "query_id", F.col("question_id").alias("relevant_id"))
    return retrieval.evaluate_retrieval(queries, found, truth)


# --- exploration and quality ------------------------------------------------------------------

@query
def class_balance(spark, sf):
    return explore.class_balance(split_pairs(spark, sf), "split")


@query
def label_shares(spark, sf):
    return explore.label_shares(labelled_pairs(spark, sf))


@query
def length_histogram(spark, sf):
    return explore.length_histogram(pairs_of(spark, sf), "question1", "question2")


@query
def length_quantiles(spark, sf):
    return explore.length_quantiles(pairs_of(spark, sf), "question1", "question2")


@query
def jaccard_by_class(spark, sf):
    return explore.jaccard_by_class(pairs_of(spark, sf), "question1", "question2")


@query
def hard_negatives(spark, sf):
    found = corpus.hard_negatives(pairs_of(spark, sf), 0.1)
    return found.select("pair_id", F.round("jaccard", 6).alias("jaccard"))


@query
def top_bigrams(spark, sf):
    return explore.top_bigrams(pairs_of(spark, sf), "question1", "question2")


@query
def duplicate_pairs(spark, sf):
    return quality.duplicate_pairs(split_pairs(spark, sf))


@query
def blank_counts(spark, sf):
    return corpus.blank_rows(raw_pairs(spark, sf), ["question1", "question2"])


@query
def pair_leakage(spark, sf):
    both = split_pairs(spark, sf)
    shared = quality.shared_pairs(both.filter("split = 'train'"), both.filter("split = 'test'"))
    return shared.agg(F.count("*").alias("n_shared"))


@query
def question_overlap(spark, sf):
    both = split_pairs(spark, sf)
    found = quality.question_overlap(both.filter("split = 'train'"), both.filter("split = 'test'"))
    return found.select("n_test", "n_shared", F.round("overlap", 6).alias("overlap"))


@query
def quality_report(spark, sf):
    return quality.quality_report(materialize(split_pairs(spark, sf), "splits"))


# --- requests, logs and streams ---------------------------------------------------------------

@query
def validate_requests(spark, sf):
    asked = table(spark, sf, "conversations").select(
        "conv_id", "turn", F.col("text").alias("question"),
        F.when(F.col("turn") > 0, F.col("turn") * 8).cast("int").alias("top_k"),
        F.when(F.col("turn") > 0, F.col("turn") / 2.0).alias("score_threshold"))
    return requests.validate_requests(asked).select(
        "conv_id", "turn", "question", "top_k", "score_threshold", F.array_join("reject_reason", ",").alias("reasons"))


@query
def validate_batches(spark, sf):
    items = table(spark, sf, "documents").select(F.col("source").alias("batch_id"))
    return requests.validate_batch_sizes(items).select("batch_id", "n_items", F.array_join("reject_reason", ",").alias("reasons"))


@query
def validate_feedback(spark, sf):
    checked = requests.validate_feedback(feedback_events(table(spark, sf, "events")))
    return checked.groupBy(F.array_join("reject_reason", ",").alias("reasons")).agg(
        F.count("*").alias("n"), F.sum("is_relevant").alias("n_relevant"))


@query
def feedback_rates(spark, sf):
    valid = requests.accepted(requests.validate_feedback(feedback_events(table(spark, sf, "events"))))
    return monitoring.feedback_rates(valid)


@query
def feedback_stream(spark, sf):
    root = scratch_path(spark, "feedback")
    stream = feedback_events(stream_of(spark, sf, "events"))
    monitoring.start_feedback(stream, root, f"{root}/checkpoint", available_now=True).awaitTermination()
    return monitoring.feedback_rates(batches.rows_of(spark, root, "feedback"))


@query
def request_summary(spark, sf):
    return requests.request_summary(request_log(table(spark, sf, "events")))


@query
def request_metrics(spark, sf):
    return plain_time(monitoring.request_metrics_by_window(request_log(table(spark, sf, "events"))))


@query
def request_metrics_stream(spark, sf):
    root = scratch_path(spark, "metrics")
    stream = monitoring.request_metrics_by_window(request_log(stream_of(spark, sf, "events")))
    batches.keep_updates(stream, root, "metrics", f"{root}/checkpoint", available_now=True).awaitTermination()
    return plain_time(batches.latest_updates(spark, root, "metrics", "window_start"))


@query
def click_through(spark, sf):
    return plain_time(monitoring.click_through_by_window(table(spark, sf, "events"), shown="view", dismissed="error"))


@query
def click_through_stream(spark, sf):
    root = scratch_path(spark, "clicks")
    stream = monitoring.click_through_by_window(stream_of(spark, sf, "events"), shown="view", dismissed="error")
    batches.keep_updates(stream, root, "clicks", f"{root}/checkpoint", available_now=True).awaitTermination()
    return plain_time(batches.latest_updates(spark, root, "clicks", "window_start"))


@query
def ingest_stream(spark, sf):
    """Documents arrive as new questions; those over the length limit are rejected."""
    root = scratch_path(spark, "ingest")
    index = vectors.build_vector_index(
        hashed_encoder()(benchmark_queries(spark, sf), "query_text", "embedding").select(
            F.col("query_id").alias("id"), "embedding"))
    target = ingest.IngestTarget(root, index.centroids, hashed_encoder())
    stream = stream_of(spark, sf, "documents").select("doc_id", F.col("text").alias("question_text"))
    ingest.start_ingest(stream, target, f"{root}/checkpoint", ["doc_id"], available_now=True).awaitTermination()
    stored = batches.rows_of(spark, root, "questions")
    linked = stored.join(batches.rows_of(spark, root, "vectors").select(F.col("id").alias("question_id")), "question_id")
    return linked.select("question_id", "question_text", "vec_id")


def _query_log(vectors_table: DataFrame, events: DataFrame) -> DataFrame:
    times = events.select(F.col("event_id").alias("query_id"), "ts")
    return vectors_table.select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_embedding")).join(times, "query_id")


@query
def query_reuse(spark, sf):
    log = _query_log(table(spark, sf, "embeddings"), table(spark, sf, "events"))
    return reuse.link_queries(log, log, REUSE_THRESHOLD).withColumn("similarity", F.round("similarity", 4))


@query
def query_reuse_stream(spark, sf):
    root = scratch_path(spark, "reuse")
    log = _query_log(stream_of(spark, sf, "embeddings"), table(spark, sf, "events"))
    reuse.start_reuse(log, root, f"{root}/checkpoint", REUSE_THRESHOLD, available_now=True).awaitTermination()
    return batches.rows_of(spark, root, "links").drop("batch_id").withColumn("similarity", F.round("similarity", 4))


# --- upkeep -----------------------------------------------------------------------------------

@query
def drift_report(spark, sf):
    found = vectors_of(spark, sf)
    return maintain.detect_drift(found, vectors.corpus_centroid(found)).drop("timestamp")


@query
def drift_by_window(spark, sf):
    found = vectors_of(spark, sf)
    times = table(spark, sf, "events").select(F.col("event_id").alias("id"), "ts")
    return plain_time(maintain.drift_by_window(found.join(times, "id"), vectors.corpus_centroid(found), window="1 day"))


@query
def upsert_latest(spark, sf):
    old = documents(spark, sf)
    turns = table(spark, sf, "conversations").select(F.col("conv_id").alias("question_id"), "turn", F.col("text").alias("question_text"))
    newest = ranking.latest_per_key(turns, "question_id", ["turn"]).drop("turn")
    return maintain.upsert(old, newest, "question_id")


@query
def index_reconcile(spark, sf):
    return quality.index_reconcile(documents(spark, sf), vectors_of(spark, sf))


@query
def unmatched_ids(spark, sf):
    return quality.unmatched_ids(documents(spark, sf), vectors_of(spark, sf))


@query
def vector_id_remap(spark, sf):
    rows = tables.questions_from_corpus(documents(spark, sf))
    mapping = vectors_of(spark, sf).select(F.col("id").alias("question_id"), F.col("id").alias("vec_id"))
    return maintain.remap_vector_ids(rows, mapping).select("question_id", "vec_id", "source")


@query
def rebuild_and_grow(spark, sf):
    """Full rebuild from the documents, then conversations are added and benchmark items replace texts."""
    root = scratch_path(spark, "versions")
    encoder = hashed_encoder()
    maintain.full_rebuild(spark, tables.questions_from_corpus(documents(spark, sf)), encoder, root)
    added = table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn") + NEW_ID_BASE).alias("question_id"), F.col("text").alias("question_text"))
    replaced = table(spark, sf, "benchmark").select(F.col("item_id").alias("question_id"), F.col("text").alias("question_text"))
    maintain.incremental_add(spark, root, added.unionByName(replaced), encoder)
    return maintain.growth_report(spark, root)


@query
def corpus_duplicates(spark, sf):
    """Nearest other document of every document, by the built-in encoder."""
    encoded = materialize(hashed_encoder()(documents(spark, sf), "question_text", "embedding").select(
        F.col("question_id").alias("id"), "embedding"), "encoded")
    index = vectors.build_vector_index(encoded)
    queries = encoded.select(F.col("id").alias("query_id"), F.col("embedding").alias("query_embedding"))
    return vectors.knn_by_bounds(queries, index, 1, skip_self=True)


# --- models -----------------------------------------------------------------------------------

def _labelled_features(spark, sf) -> DataFrame:
    cleaned = materialize(corpus.apply_cleaning(splits.hash_split(labelled_pairs(spark, sf), "pair_id"), "classical"), "cleaned")
    return training.split_features(cleaned, "pair_id")[0]


@query
def train_logistic_regression(spark, sf):
    table_ = _labelled_features(spark, sf)
    model = training.train_logistic_regression(table_.filter("split = 'train'"), FEATURES)
    return training.evaluate_models([model], table_)


@query
def train_boosted_trees(spark, sf):
    """Importance of the features under the full settings; the AUC of the validation rows stops the boosting."""
    rows = _labelled_features(spark, sf).filter("split != 'test'").withColumn("validation", F.col("split") == "val")
    return training.feature_importance(training.train_boosted_trees(rows, FEATURES, "validation"), spark)


@query
def boosted_first_split(spark, sf):
    """The first tree of depth one on the features that SQL can express, and the AUC it gives validation rows."""
    pairs = splits.hash_split(labelled_pairs(spark, sf), "pair_id").filter("split != 'test'")
    a, b = F.col("question1"), F.col("question2")
    table_ = materialize(pairs.withColumns({**length_features(a, b), **overlap_features(a, b)}).select(
        "pair_id", "is_duplicate", *NATIVE_FEATURES, (F.col("split") == "val").alias("validation")), "features")
    model = training.train_boosted_trees(
        table_, NATIVE_FEATURES, "validation", rounds=1, depth=1, row_share=1.0, column_share=1.0, bins=BOOST_BINS)
    tree = model.trees[0]
    rows = [(model.features[tree.feature[0]], float(model.edges[tree.feature[0]][tree.cut[0]]),
             *(v / boosting.UNIT for v in tree.value[1:3]), model.aucs[0])] if tree.feature[0] >= 0 else []
    found = spark.createDataFrame(rows, "feature string, threshold double, low double, high double, auc double")
    return found.select("feature", "threshold", *[F.round(c, 5).alias(c) for c in ("low", "high")], F.round("auc", 6).alias("auc"))


# --- files ------------------------------------------------------------------------------------

@query
def csv_round_trip(spark, sf):
    path = scratch_path(spark, "corpus") + ".csv"
    docs = documents(spark, sf)
    docs.write.option("header", True).option("escape", '"').csv(path)
    return tables.read_any(spark, path, docs.schema, multi_line=True)


@query
def split_files(spark, sf):
    path = scratch_path(spark, "splits")
    tables.write_splits(split_pairs(spark, sf), path)
    return tables.read_splits(spark, path, "test").select("pair_id", "qid1", "qid2", "is_duplicate")
