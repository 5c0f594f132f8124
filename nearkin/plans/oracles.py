"""The same questions as plain SQL over the test tables, for an independent engine."""

from __future__ import annotations

# The English stop words that Spark's stop word filter ships.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its
itself they them their theirs themselves what which who whom this that these those am is are was were be been being have
has had having do does did doing a an the and but if or because as until while of at by for with about against between
into through during before after above below to from up down in out on off over under again further then once here there
when where why how all any both each few more most other some such no nor not only own same so than too very s t can will
just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's
we're they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't
wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's
where's who's why's would
""".split()

WS = r"[\t-\r\x1c-\x20\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NON_WS = WS.replace("[", "[^", 1)
W = r"[\p{L}\p{N}_]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def no_html(x: str) -> str:
    decoded = x
    for entity, char in (("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©")):
        decoded = f"replace({decoded}, '{entity}', '{char}')"
    # an ampersand entity is also valid without its semicolon
    decoded = f"regexp_replace({decoded}, '&amp;?', '&', 'g')"
    return collapse(f"regexp_replace({decoded}, '<[^>]+>', ' ', 'g')")


def no_urls(x: str) -> str:
    return f"regexp_replace({x}, '(https?://|www\\.){NON_WS}+', '<URL>', 'gi')"


def transformer(x: str) -> str:
    return collapse(no_urls(no_html(x)))


def classical(x: str) -> str:
    kept = W[:-1] + WS[1:]
    return collapse(f"regexp_replace(lower({no_urls(no_html(x))}), '[^{kept[1:]}', ' ', 'g')")


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> '')"


def n_words(x: str) -> str:
    return f"len({words(x)})::INT"


def jaccard(a: str, b: str) -> str:
    wa, wb = words(f"lower({a})"), words(f"lower({b})")
    inter = f"len(list_intersect({wa}, {wb}))"
    union = f"len(list_distinct(list_concat({wa}, {wb})))"
    return f"coalesce({inter}::DOUBLE / nullif({union}, 0), 0.0)"


def split_of(key: str) -> str:
    place = f"(('0x' || substr(md5({key}::VARCHAR || '|42'), 1, 8))::BIGINT / 4294967296.0)"
    return f"CASE WHEN {place} < 0.15 THEN 'test' WHEN {place} < 0.2 THEN 'val' ELSE 'train' END"


def dot(a: str, b: str) -> str:
    return f"list_inner_product({a}::DOUBLE[], {b}::DOUBLE[])"


def cosine(a: str, b: str) -> str:
    return f"({dot(a, b)} / (sqrt({dot(a, a)}) * sqrt({dot(b, b)})))"


RAW = """raw AS (
  SELECT a.doc_id // 2 AS idx, a.text AS t1, b.text AS t2, (la.quality = lb.quality)::INT AS label
  FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1 AND a.doc_id % 2 = 0
  LEFT JOIN labels la ON la.doc_id = a.doc_id LEFT JOIN labels lb ON lb.doc_id = b.doc_id)"""
PAIRS = f"""{RAW}, pairs AS (
  SELECT * FROM (SELECT idx AS pair_id, idx * 2 AS qid1, idx * 2 + 1 AS qid2, {strip('t1')} AS question1,
    {strip('t2')} AS question2, coalesce(label, 0) AS is_duplicate, label IS NOT NULL AS known FROM raw)
  WHERE length(question1) > 0 AND length(question2) > 0)"""
SPLIT = f"{PAIRS}, splits AS (SELECT *, {split_of('pair_id')} AS split FROM pairs)"

SCORED_DOCS = f"""scored AS (
  SELECT d.doc_id AS id, l.quality AS y_true,
    round(coalesce(len(list_distinct({words('lower(d.text)')}))::DOUBLE / nullif(len({words('lower(d.text)')}), 0), 0), 4) AS y_prob
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"""
SCORED_PAIRS = f"""{PAIRS}, scored AS (
  SELECT pair_id AS id, question1, question2, is_duplicate AS y_true,
    round({jaccard('question1', 'question2')}, 6) AS y_prob FROM pairs WHERE known)"""


def curve(by: str = "") -> str:
    """Distinct scores with counts at and above them, from table ``scored``."""
    over = f"PARTITION BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"""points AS (
  SELECT {lead}y_prob AS threshold, sum((y_true = 1)::INT) AS pos, sum((y_true = 0)::INT) AS neg
  FROM scored GROUP BY ALL), curve AS (
  SELECT *, sum(pos) OVER ({over} ORDER BY threshold DESC) AS tp, sum(neg) OVER ({over} ORDER BY threshold DESC) AS fp,
    sum(pos) OVER ({over}) AS n_pos, sum(neg) OVER ({over}) AS n_neg FROM points)"""


def metrics(threshold: float, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    return f"""metrics AS (
  SELECT {lead}n, round(coalesce(tp / nullif(tp + fp, 0), 0), 4) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 4) AS recall,
    round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 4) AS f1, round(auc, 4) AS auc_roc, round(ap, 4) AS avg_precision
  FROM (SELECT {lead}sum(pos + neg)::BIGINT AS n,
    sum(CASE WHEN threshold >= {threshold} THEN pos ELSE 0 END)::DOUBLE AS tp, sum(CASE WHEN threshold >= {threshold} THEN neg ELSE 0 END)::DOUBLE AS fp,
    sum(CASE WHEN threshold < {threshold} THEN pos ELSE 0 END)::DOUBLE AS fn,
    CASE WHEN max(n_pos) > 0 AND max(n_neg) > 0 THEN sum(pos * (n_neg - fp + neg / 2.0)) / (max(n_pos)::DOUBLE * max(n_neg)) END AS auc,
    CASE WHEN max(n_pos) > 0 AND max(n_neg) > 0 THEN sum(pos * tp::DOUBLE / (tp + fp)) / max(n_pos) END AS ap
    FROM curve {'GROUP BY ' + by if by else ''}))"""


def tfidf_terms(x: str) -> str:
    """Term rows of table ``d`` with its columns ``key`` and ``t``."""
    return f"""toks AS (SELECT key, regexp_extract_all(strip_accents(lower({x})), '{W}{{2,}}') AS w FROM d),
  grams AS (SELECT key, unnest(list_concat(w, list_transform(list_zip(w[:-2], w[2:]), lambda z: z[1] || ' ' || z[2]))) AS term FROM toks)"""


TFIDF = f"""{SPLIT}, d AS (
  SELECT pair_id * 2 AS key, question1 AS t FROM pairs UNION ALL SELECT pair_id * 2 + 1, question2 FROM pairs),
  {tfidf_terms('t')}, tf AS (SELECT key, term, count(*) AS tf FROM grams GROUP BY ALL),
  train AS (SELECT pair_id FROM splits WHERE split = 'train'),
  vocabulary AS (
    SELECT term, ln((1.0 + 2 * (SELECT count(*) FROM train)) / (1.0 + df)) + 1 AS idf FROM (
      SELECT term, sum(tf) AS cf, count(*) AS df FROM tf WHERE key // 2 IN (SELECT pair_id FROM train)
      GROUP BY term ORDER BY cf DESC, term LIMIT 50000))"""

POSTINGS = f"""postings AS (
  SELECT question_id, term, count(*)::INT AS tf FROM (
    SELECT doc_id AS question_id, unnest(regexp_extract_all(lower(text), '{W}+')) AS term FROM documents) GROUP BY ALL),
  lengths AS (SELECT doc_id AS question_id, len(regexp_extract_all(lower(text), '{W}+'))::INT AS doc_len FROM documents),
  terms AS (SELECT term, count(*) AS df FROM postings GROUP BY term),
  stats AS (SELECT count(*) AS n, avg(doc_len) AS avgdl FROM lengths),
  idf AS (SELECT term, df, ln((n - df + 0.5) / (df + 0.5) + 1.0) AS idf FROM terms, stats)"""


def bm25(queries: str, k: int = 10) -> str:
    return f"""{POSTINGS}, queries AS ({queries}),
  qterms AS (SELECT query_id, term, count(*) AS qtf FROM (
    SELECT query_id, unnest(regexp_extract_all(lower(query_text), '{W}+')) AS term FROM queries) GROUP BY ALL),
  keyword_scores AS (SELECT query_id, question_id,
    sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * doc_len / avgdl))) AS score
    FROM qterms JOIN idf USING (term) JOIN postings USING (term) JOIN lengths USING (question_id), stats GROUP BY ALL),
  keyword_hits AS (SELECT * FROM (SELECT query_id, question_id, score,
    row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, question_id)::INT AS rank FROM keyword_scores)
    WHERE rank <= {k})"""


def knn(queries: str, k: int, name: str = "hits", extra: str = "") -> str:
    """Table ``name`` of exact neighbours of ``queries(query_id, v)``."""
    return f"""{name}_all AS (SELECT query_id, vec_id AS question_id, round({dot('v', 'embedding')}, 9) AS s
    FROM ({queries}) q, embeddings {extra}),
  {name} AS (SELECT query_id, question_id, rank, round(s, 4) AS score FROM (SELECT *,
    row_number() OVER (PARTITION BY query_id ORDER BY s DESC, question_id)::INT AS rank FROM {name}_all) WHERE rank <= {k})"""


SELF = "SELECT vec_id AS query_id, embedding AS v FROM embeddings"
LINKED = "SELECT item_id AS query_id, embedding AS v FROM benchmark JOIN embeddings ON item_id = vec_id"
KNN_SELF = f"WITH {knn(SELF, 10)} SELECT query_id, rank, question_id, score FROM hits"


def rrf(first: str, second: str) -> str:
    return f"""lists AS (SELECT query_id, question_id, rank, 0 AS l FROM {first} UNION ALL SELECT query_id, question_id, rank, 1 FROM {second}),
  fused AS (SELECT query_id, question_id, sum(1.0::DOUBLE / (60 + rank)) AS s, min(l * 4294967296 + rank) AS f FROM lists GROUP BY ALL)
  SELECT query_id, rank, question_id, round(s, 6) AS score FROM (SELECT *,
    row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, f)::INT AS rank FROM fused) WHERE rank <= 10"""


FIND = f"""WITH {knn(LINKED, 10)}, found AS (
  SELECT query_id, question_id, score, row_number() OVER (PARTITION BY query_id ORDER BY rank)::INT AS rank
  FROM hits JOIN documents ON doc_id = question_id)"""
OWN_LIMITS = f"""WITH {knn(LINKED, 40)}, found AS (
  SELECT query_id, question_id, score, row_number() OVER (PARTITION BY query_id ORDER BY rank)::INT AS rank
  FROM hits JOIN documents ON doc_id = question_id WHERE rank <= 2 * (query_id % 20 + 1))"""
CENTER = """dims AS (SELECT generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings),
  means AS (SELECT pos, avg(x) AS m FROM dims GROUP BY pos),
  center AS (SELECT pos, m / sqrt((SELECT sum(m * m) FROM means)) AS c FROM means),
  center_list AS (SELECT list(c ORDER BY pos) AS c FROM center)"""
RERANKED = f"""WITH {knn(SELF, 10)}, cand AS (
  SELECT h.*, round({jaccard('q.text', 'd.text')}, 4) AS js FROM hits h JOIN documents q ON q.doc_id = query_id JOIN documents d ON d.doc_id = question_id),
  again AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY js DESC, rank)::INT AS r2 FROM cand)"""
REQUEST_LOG = """log AS (SELECT ts, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, value AS latency_ms,
  event_type = 'click' AS was_cached FROM events)"""
FEEDBACK = """feedback AS (SELECT user_id AS retrieved_question_id, (event_type = 'click')::INT AS is_relevant,
  CASE WHEN value < 10 THEN floor(value)::INT END AS user_rating FROM events)"""
VALID = "user_rating IS NULL OR user_rating BETWEEN 1 AND 5"
FEEDBACK_RATES = f"""WITH {FEEDBACK} SELECT retrieved_question_id, count(*) AS n, round(avg(is_relevant), 4) AS relevance_rate,
  round(avg(user_rating), 4) AS mean_rating FROM feedback WHERE {VALID} GROUP BY ALL"""
REQUEST_METRICS = f"""WITH {REQUEST_LOG} SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, count(*) AS n_requests,
  sum(was_cached::INT)::BIGINT AS cache_hits, sum((NOT was_cached)::INT)::BIGINT AS cache_misses,
  round(avg(was_cached::INT), 4) AS cache_hit_rate, sum((status >= 400)::INT)::BIGINT AS n_errors,
  round(avg(latency_ms), 4) AS mean_latency FROM log GROUP BY 1"""
CLICK_THROUGH = """SELECT *, coalesce(click_through < 0.15, false) AS alert FROM (
  SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, sum((event_type = 'view')::INT)::BIGINT AS n_shown,
  sum((event_type = 'click')::INT)::BIGINT AS n_clicked, sum((event_type = 'error')::INT)::BIGINT AS n_dismissed,
  round(sum((event_type = 'click')::INT)::DOUBLE / nullif(sum((event_type = 'view')::INT), 0), 4) AS click_through,
  round(sum((event_type = 'error')::INT)::DOUBLE / nullif(sum((event_type = 'view')::INT), 0), 4) AS dismissal_rate
  FROM events GROUP BY 1)"""
BIGRAM_STOP = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS) + "]"
DUPLICATES = """SELECT split, sum(n - 1)::BIGINT AS n_duplicates FROM (
  SELECT split, question1, question2, count(*) AS n FROM splits GROUP BY ALL) GROUP BY split"""


def ordered(where: str) -> str:
    return (f"(SELECT lower(question1) AS a, lower(question2) AS b FROM splits WHERE {where} "
            f"UNION SELECT lower(question2), lower(question1) FROM splits WHERE {where})")


LEAKED = f"SELECT count(*) AS n FROM ({ordered('split = $$train$$')} INTERSECT {ordered('split = $$test$$')})"
SEEN = """test_q AS (SELECT question1 AS q FROM splits WHERE split = 'test' UNION SELECT question2 FROM splits WHERE split = 'test'),
  train_q AS (SELECT question1 AS q FROM splits WHERE split = 'train' UNION SELECT question2 FROM splits WHERE split = 'train'),
  seen AS (SELECT count(*) AS n_test, count(t.q) AS n_shared, coalesce(count(t.q)::DOUBLE / nullif(count(*), 0), 0) AS overlap
    FROM test_q LEFT JOIN train_q t ON t.q = test_q.q)"""


def native_features() -> dict[str, str]:
    return {
        "len_q1_chars": "length(question1)", "len_q2_chars": "length(question2)",
        "len_diff_chars": "abs(length(question1) - length(question2))",
        "len_q1_words": n_words("question1"), "len_q2_words": n_words("question2"),
        "len_diff_words": f"abs({n_words('question1')} - {n_words('question2')})",
        "common_word_ratio": jaccard("question1", "question2"),
        "common_word_count": f"len(list_intersect({words('lower(question1)')}, {words('lower(question2)')}))",
    }


def corr_rows() -> str:
    rows = [f"SELECT '{name}' AS feature, count(*) AS n, corr(({x})::DOUBLE, is_duplicate::DOUBLE) AS r FROM pairs WHERE known"
            for name, x in native_features().items()]
    return (f"WITH {PAIRS}, rows AS ({' UNION ALL '.join(rows)}) "
            "SELECT feature, n, round(r, 6) AS r, abs(r) < 0.05 AS weak FROM rows")


def first_split(bins: int = 16) -> str:
    """The best cut of all features by slopes and curvatures at even odds, and its AUC on validation rows."""
    long = " UNION ALL ".join(
        f"SELECT pair_id, split, is_duplicate AS y, {i} AS f, '{name}' AS feature, ({x})::DOUBLE AS x FROM splits WHERE known AND split <> 'test'"
        for i, (name, x) in enumerate(native_features().items()))
    shares = ", ".join(f"{i / bins}" for i in range(1, bins))
    return f"""WITH {SPLIT}, long AS ({long}),
      weight AS (SELECT sum(1 - y) / sum(y)::DOUBLE AS w FROM long WHERE f = 0 AND split = 'train'),
      rows AS (SELECT *, round(CASE y WHEN 1 THEN w ELSE 1 END * (0.5 - y) * 1048576) AS g,
        round(CASE y WHEN 1 THEN w ELSE 1 END * 0.25 * 1048576) AS h FROM long, weight),
      edges AS (SELECT DISTINCT f, unnest(quantile_disc(x, [{shares}])) AS edge FROM rows WHERE split = 'train' GROUP BY f),
      sums AS (SELECT f, any_value(feature) AS feature, edge, sum(CASE WHEN x <= edge THEN g ELSE 0 END) AS gl,
        sum(CASE WHEN x <= edge THEN h ELSE 0 END) AS hl, sum(g) AS g, sum(h) AS h FROM rows JOIN edges USING (f) WHERE split = 'train' GROUP BY f, edge),
      gains AS (SELECT *, (gl / 1048576) ** 2 / (hl / 1048576 + 1) + ((g - gl) / 1048576) ** 2 / ((h - hl) / 1048576 + 1)
        - (g / 1048576) ** 2 / (h / 1048576 + 1) AS gain FROM sums WHERE hl >= 1048576 AND h - hl >= 1048576),
      best AS (SELECT *, round_even(-gl / (hl + 1048576) * 0.05 * 1048576, 0) AS low,
        round_even(-(g - gl) / (h - hl + 1048576) * 0.05 * 1048576, 0) AS high
        FROM gains WHERE gain > 1e-9 ORDER BY round(gain, 9) DESC, f, edge LIMIT 1),
      held AS (SELECT y, floor(CASE WHEN x <= edge THEN low ELSE high END / 1024) AS step FROM rows JOIN best USING (f) WHERE split = 'val'),
      area AS (SELECT sum((a.step > b.step)::INT + 0.5 * (a.step = b.step)::INT) / count(*) AS auc FROM held a JOIN held b ON a.y = 1 AND b.y = 0)
      SELECT feature, edge AS threshold, round(low / 1048576, 5) AS low, round(high / 1048576, 5) AS high, round(auc, 6) AS auc FROM best, area"""


STRATIFIED = f"""WITH {PAIRS}, sizes AS (SELECT is_duplicate, count(*) AS n FROM pairs GROUP BY 1),
  t1 AS (SELECT *, ceil(round(sum(n) OVER () * 0.15, 6)) AS total, sum(n) OVER () AS everything FROM sizes),
  t2 AS (SELECT *, floor(n * total / everything) AS low, n * total / everything - floor(n * total / everything) AS frac FROM t1),
  t3 AS (SELECT is_duplicate, n, (low + CASE WHEN row_number() OVER (ORDER BY frac DESC, is_duplicate) <= total - sum(low) OVER () THEN 1 ELSE 0 END)::BIGINT AS n_test FROM t2),
  v1 AS (SELECT *, n - n_test AS m FROM t3),
  v2 AS (SELECT *, ceil(round(sum(m) OVER () * (0.05::DOUBLE / (1.0 - 0.15::DOUBLE)), 6)) AS total, sum(m) OVER () AS everything FROM v1),
  v3 AS (SELECT *, floor(m * total / everything) AS low, m * total / everything - floor(m * total / everything) AS frac FROM v2),
  v4 AS (SELECT is_duplicate, n_test, (low + CASE WHEN row_number() OVER (ORDER BY frac DESC, is_duplicate) <= total - sum(low) OVER () THEN 1 ELSE 0 END)::BIGINT AS n_val FROM v3),
  placed AS (SELECT pair_id, is_duplicate, row_number() OVER (PARTITION BY is_duplicate ORDER BY md5(pair_id::VARCHAR || '|42'), pair_id) AS place FROM pairs)
  SELECT pair_id, is_duplicate, CASE WHEN place <= n_test THEN 'test' WHEN place <= n_test + n_val THEN 'val' ELSE 'train' END AS split
  FROM placed JOIN v4 USING (is_duplicate)"""

REUSE = """WITH log AS (SELECT vec_id AS q, embedding::DOUBLE[] AS v, ts FROM embeddings JOIN events ON event_id = vec_id),
  close AS (SELECT a.q, b.q AS earlier, b.ts, round(list_inner_product(a.v, b.v), 9) AS s
    FROM log a JOIN log b ON (b.ts, b.q) < (a.ts, a.q) WHERE round(list_inner_product(a.v, b.v), 9) >= 0.35),
  first_one AS (SELECT * FROM close QUALIFY row_number() OVER (PARTITION BY q ORDER BY ts, earlier) = 1)
  SELECT log.q AS query_id, earlier AS matched_query_id, round(s, 4) AS similarity, earlier IS NOT NULL AS was_cached
  FROM log LEFT JOIN first_one USING (q)"""


ORACLES: dict[str, str] = {
    "query_reuse": REUSE,
    "query_reuse_stream": REUSE,
    "flatten_pairs": f"WITH {PAIRS} SELECT qid1, qid2, question1, question2, is_duplicate FROM pairs",
    "flatten_pairs_nested": f"WITH {PAIRS} SELECT qid1, qid2, question1, question2, is_duplicate FROM pairs",
    "corpus_dedupe": f"""WITH {RAW}, sides AS (SELECT idx * 2 AS id, {strip('t1')} AS t FROM raw UNION ALL SELECT idx * 2 + 1, {strip('t2')} FROM raw)
      SELECT min(id) AS question_id, t AS question_text FROM sides WHERE length(t) > 0 GROUP BY t""",
    "corpus_size": f"""WITH {RAW}, sides AS (SELECT {strip('t1')} AS t FROM raw UNION SELECT {strip('t2')} FROM raw)
      SELECT count(*) AS n_questions FROM sides WHERE length(t) > 0""",
    "canonical_pairs": f"""WITH {PAIRS}, sides AS (SELECT idx * 2 AS id, {strip('t1')} AS t FROM raw UNION ALL SELECT idx * 2 + 1, {strip('t2')} FROM raw),
      ids AS (SELECT min(id) AS id, t FROM sides GROUP BY t)
      SELECT a.id AS qid1, b.id AS qid2, is_duplicate FROM pairs JOIN ids a ON a.t = question1 JOIN ids b ON b.t = question2""",
    "truth_table": f"""WITH {PAIRS} SELECT qid1 AS query_id, qid2 AS relevant_id FROM pairs WHERE is_duplicate = 1
      UNION ALL SELECT qid2, qid1 FROM pairs WHERE is_duplicate = 1""",
    "clean_classical": f"SELECT doc_id AS question_id, {classical('text')} AS cleaned FROM documents",
    "clean_transformer": f"SELECT doc_id AS question_id, {transformer('text')} AS question_clean FROM documents",
    "clean_pairs": f"""WITH {PAIRS} SELECT * FROM (SELECT qid1, qid2, {classical('question1')} AS q1_classical, {classical('question2')} AS q2_classical,
      {transformer('question1')} AS q1_transformer, {transformer('question2')} AS q2_transformer FROM pairs)
      WHERE q1_classical <> '' AND q2_classical <> '' AND q1_transformer <> '' AND q2_transformer <> ''""",
    "html_strip_pages": f"SELECT page_id, {no_html('html')} AS plain FROM pages",
    "clean_pages_classical": f"SELECT page_id, {classical('''(url || ' ' || html)''')} AS cleaned FROM pages",
    "prepared_splits": f"""WITH {PAIRS}, cleaned AS (SELECT *, {split_of('''(qid1::VARCHAR || '-' || qid2::VARCHAR)''')} AS split FROM pairs
      WHERE {classical('question1')} <> '' AND {classical('question2')} <> '' AND {transformer('question1')} <> '' AND {transformer('question2')} <> '')
      SELECT split, count(*) AS n, sum(is_duplicate)::BIGINT AS n_positive FROM cleaned GROUP BY split""",
    "training_examples": f"WITH {PAIRS} SELECT question1 AS text1, question2 AS text2, is_duplicate::DOUBLE AS label FROM pairs",
    "hash_split": f"WITH {SPLIT} SELECT pair_id, split FROM splits",
    "stratified_split": STRATIFIED,
    "seeded_sample": "SELECT doc_id, lang, n_chars FROM documents ORDER BY md5(doc_id::VARCHAR || '|42'), doc_id LIMIT 1000",
    "inspection_sample": f"""WITH {PAIRS} SELECT pair_id, question1, question2, is_duplicate FROM pairs
      ORDER BY md5(pair_id::VARCHAR || '|42'), pair_id LIMIT 10""",
    "dense_ids": "SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS row_index FROM documents",
    "length_feature_table": f"""WITH {PAIRS} SELECT pair_id, length(question1)::INT AS len_q1_chars, length(question2)::INT AS len_q2_chars,
      abs(length(question1) - length(question2))::INT AS len_diff_chars, {n_words('question1')} AS len_q1_words,
      {n_words('question2')} AS len_q2_words, abs({n_words('question1')} - {n_words('question2')}) AS len_diff_words FROM pairs""",
    "overlap_feature_table": f"""WITH {PAIRS} SELECT pair_id, round({jaccard('question1', 'question2')}, 6) AS common_word_ratio,
      len(list_intersect({words('lower(question1)')}, {words('lower(question2)')}))::INT AS common_word_count FROM pairs""",
    "tfidf_vocabulary": f"WITH {TFIDF} SELECT term, round(idf, 6) AS idf FROM vocabulary",
    "tfidf_pair_cosine": f"""WITH {TFIDF}, weights AS (SELECT key, term, (1 + ln(tf)) * idf AS w FROM tf JOIN vocabulary USING (term)),
      norms AS (SELECT key, sqrt(sum(w * w)) AS n FROM weights GROUP BY key),
      dots AS (SELECT a.key // 2 AS pair_id, sum(a.w * b.w) AS dot FROM weights a JOIN weights b ON b.key = a.key + 1 AND a.key % 2 = 0 AND a.term = b.term GROUP BY 1)
      SELECT p.pair_id, round(coalesce(dot / (n1.n * n2.n), 0), 6) AS tfidf_cosine FROM pairs p LEFT JOIN dots USING (pair_id)
      LEFT JOIN norms n1 ON n1.key = p.pair_id * 2 LEFT JOIN norms n2 ON n2.key = p.pair_id * 2 + 1""",
    "word_vector_cosine": f"""WITH {PAIRS}, counted AS (SELECT word, count(*) AS cf FROM (SELECT unnest({words('lower(text)')}) AS word FROM documents) GROUP BY word),
      placed AS (SELECT word, row_number() OVER (ORDER BY cf DESC, word) - 1 AS vec_id FROM counted),
      lookup AS (SELECT word, embedding FROM placed JOIN embeddings USING (vec_id)),
      sides AS (SELECT pair_id * 2 AS key, unnest({words('lower(question1)')}) AS word FROM pairs UNION ALL SELECT pair_id * 2 + 1, unnest({words('lower(question2)')}) FROM pairs),
      dims AS (SELECT key, c, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS x
        FROM (SELECT key, word, count(*) AS c FROM sides GROUP BY ALL) JOIN lookup USING (word)),
      means AS (SELECT key, pos, sum(c * x) AS m FROM dims GROUP BY ALL),
      lists AS (SELECT key, list(m ORDER BY pos) AS v FROM means GROUP BY key)
      SELECT pair_id, round(coalesce({cosine('a.v', 'b.v')}, 0), 6) AS wv_cosine_similarity FROM pairs
      LEFT JOIN lists a ON a.key = pair_id * 2 LEFT JOIN lists b ON b.key = pair_id * 2 + 1""",
    "feature_correlations": corr_rows(),
    "boosted_first_split": first_split(),
    "bm25_postings": f"WITH {POSTINGS} SELECT term, question_id, tf, doc_len FROM postings JOIN lengths USING (question_id)",
    "bm25_terms": f"WITH {POSTINGS} SELECT term, df, round(idf, 6) AS idf FROM idf",
    "bm25_search": f"WITH {bm25('SELECT item_id AS query_id, text AS query_text FROM benchmark')} SELECT query_id, rank, question_id, round(score, 4) AS score FROM keyword_hits",
    "bm25_search_segments": f"WITH {bm25('SELECT item_id AS query_id, text AS query_text FROM benchmark')} SELECT query_id, rank, question_id, round(score, 4) AS score FROM keyword_hits",
    "bm25_search_merged": f"""WITH {bm25('SELECT item_id AS query_id, text AS query_text FROM benchmark')}, d AS (SELECT count(*) AS n FROM documents)
  SELECT query_id, rank, question_id, round(score, 4) AS score, 1 AS segments, n AS live_rows, n AS written_rows FROM keyword_hits, d""",
    "bm25_search_stored": f"WITH {bm25('SELECT item_id AS query_id, text AS query_text FROM benchmark')} SELECT query_id, rank, question_id, round(score, 4) AS score FROM keyword_hits",
    "bm25_search_turns": f"""WITH {bm25("SELECT conv_id * 1000 + turn AS query_id, text AS query_text FROM conversations WHERE role = 'user'")}
      SELECT query_id, rank, question_id, round(score, 4) AS score FROM keyword_hits""",
    "rrf_fusion": f"""WITH {knn(LINKED, 10, 'near')}, {knn('SELECT query_id, list_transform(v, lambda x: -x) AS v FROM (' + LINKED + ')', 10, 'far')},
      {rrf('near', 'far')}""",
    "hybrid_search": f"""WITH {knn(LINKED, 10, 'near')}, {bm25('SELECT item_id AS query_id, text AS query_text FROM benchmark WHERE item_id IN (SELECT vec_id FROM embeddings)')},
      {rrf('near', 'keyword_hits')}""",
    "knn_exact": KNN_SELF,
    "knn_clustered_full_probe": KNN_SELF,
    "knn_clustered": KNN_SELF,
    "knn_clustered_recall": f"WITH {knn(SELF, 10)} SELECT count(*) AS n_exact, 1.0::DOUBLE AS recall_at_10 FROM hits",
    "knn_small_cells_recall": f"""WITH {knn(SELF, 10)} SELECT count(*) AS n_exact, (SELECT count(*) FROM embeddings) // 3 > 64 AS cells_left_out,
      true AS enough FROM hits""",
    "self_retrieval": "SELECT vec_id AS query_id, vec_id AS found_id, 1.0::DOUBLE AS score, true AS ok FROM embeddings",
    "find_similar": f"{FIND} SELECT query_id, rank, question_id, score FROM found WHERE score >= 0.3 AND rank <= 5",
    "find_similar_requests": f"{OWN_LIMITS} SELECT query_id, rank, question_id, score FROM found WHERE score >= query_id % 5 / 10.0 AND rank <= query_id % 20 + 1",
    "find_similar_requests_rerank": f"""{OWN_LIMITS}, cand AS (SELECT f.query_id, f.question_id, f.rank, round({jaccard('q.text', 'd.text')}, 4) AS js
      FROM found f JOIN benchmark q ON q.item_id = query_id JOIN documents d ON d.doc_id = question_id),
      again AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY js DESC, rank)::INT AS r2 FROM cand)
      SELECT query_id, r2 AS rank, question_id, js AS score FROM again WHERE js >= query_id % 5 / 10.0 AND r2 <= query_id % 20 + 1""",
    "find_similar_responses": f"""{FIND} SELECT b.item_id AS query_id, b.text AS query_text, count(f.rank)::INT AS result_count
      FROM benchmark b JOIN embeddings ON vec_id = item_id LEFT JOIN found f ON f.query_id = b.item_id AND f.score >= 0.35 AND f.rank <= 5 GROUP BY ALL""",
    "rerank_overlap": f"{RERANKED} SELECT query_id, r2 AS rank, question_id, js AS score FROM again WHERE r2 <= 5",
    "compare_rerank": f"{RERANKED} SELECT query_id, question_id, rank AS vector_rank, score AS vector_score, r2 AS scorer_rank, js AS scorer_score FROM again",
    "pair_cosine": f"""SELECT a.vec_id // 2 AS pair_id, round({cosine('a.embedding', 'b.embedding')}, 6) AS cosine
      FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1 AND a.vec_id % 2 = 0""",
    "l2_normalized": f"""WITH s AS (SELECT vec_id, list_transform(embedding, lambda x: (x * (label + 2))::DOUBLE) AS v FROM embeddings),
      n AS (SELECT vec_id, v, sqrt({dot('v', 'v')}) AS n FROM s)
      SELECT vec_id, (generate_subscripts(v, 1) - 1)::INT AS pos, round(unnest(v) / n, 6) AS x FROM n""",
    "norm_check": f"SELECT count(*) AS n_vectors, max(abs(sqrt({dot('embedding', 'embedding')}) - 1)) <= 1e-4 AS all_unit FROM embeddings",
    "corpus_centroid": f"WITH {CENTER} SELECT pos::INT AS pos, round(c, 6) AS x FROM center",
    "cell_assignment": f"""WITH dims AS (SELECT label, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings),
      means AS (SELECT label, pos, avg(x) AS m FROM dims GROUP BY ALL), lists AS (SELECT label, list(m ORDER BY pos) AS c FROM means GROUP BY label),
      scored AS (SELECT vec_id, l.label AS cell, round({dot('embedding', 'c')} / sqrt({dot('c', 'c')}), 9) AS s FROM embeddings, lists l)
      SELECT vec_id AS id, cell FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, cell) AS r FROM scored) WHERE r = 1""",
    "confusion_counts": f"""WITH {SCORED_DOCS} SELECT count(*) FILTER (y_true = 0 AND y_prob < 0.5) AS tn, count(*) FILTER (y_true = 0 AND y_prob >= 0.5) AS fp,
      count(*) FILTER (y_true = 1 AND y_prob < 0.5) AS fn, count(*) FILTER (y_true = 1 AND y_prob >= 0.5) AS tp FROM scored""",
    "class_report": f"""WITH {SCORED_DOCS}, c AS (SELECT count(*) FILTER (y_true = 0 AND y_prob < 0.5)::DOUBLE AS tn, count(*) FILTER (y_true = 0 AND y_prob >= 0.5)::DOUBLE AS fp,
      count(*) FILTER (y_true = 1 AND y_prob < 0.5)::DOUBLE AS fn, count(*) FILTER (y_true = 1 AND y_prob >= 0.5)::DOUBLE AS tp FROM scored),
      m AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
        coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0, coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0) AS f0,
        tp + fn AS n1, tn + fp AS n0, (tn + tp) / (tn + fp + fn + tp) AS acc FROM c),
      rows AS (SELECT '0' AS class_name, p0 AS p, r0 AS r, f0 AS f, n0 AS s FROM m UNION ALL SELECT '1', p1, r1, f1, n1 FROM m
        UNION ALL SELECT 'accuracy', acc, acc, acc, n0 + n1 FROM m UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n0 + n1 FROM m
        UNION ALL SELECT 'weighted avg', (p0 * n0 + p1 * n1) / (n0 + n1), (r0 * n0 + r1 * n1) / (n0 + n1), (f0 * n0 + f1 * n1) / (n0 + n1), n0 + n1 FROM m)
      SELECT class_name, round(p, 4) AS precision, round(r, 4) AS recall, round(f, 4) AS f1, s::BIGINT AS support FROM rows""",
    "classifier_metrics": f"WITH {SCORED_DOCS}, {curve()}, {metrics(0.5)} SELECT * FROM metrics",
    "threshold_curve": f"""WITH {SCORED_DOCS}, {curve()} SELECT threshold, round(fp::DOUBLE / n_neg, 6) AS fpr, round(tp::DOUBLE / n_pos, 6) AS tpr,
      round(tp::DOUBLE / (tp + fp), 6) AS precision, round(tp::DOUBLE / n_pos, 6) AS recall FROM curve""",
    "best_threshold": f"""WITH {SCORED_DOCS}, {curve()}, f AS (SELECT threshold, tp::DOUBLE / (tp + fp) AS p, tp::DOUBLE / n_pos AS r FROM curve),
      g AS (SELECT threshold, round(2 * p * r / (p + r + 1e-8), 9) AS f1 FROM f) SELECT threshold, round(f1, 4) AS f1 FROM g ORDER BY g.f1 DESC, threshold LIMIT 1""",
    "slice_metrics": f"""WITH {SCORED_PAIRS.replace('scored AS', 'base AS')}, lens AS (SELECT *, ({n_words('question1')} + {n_words('question2')}) / 2.0 AS m FROM base),
      scored AS (SELECT CASE WHEN m < 8 THEN 'short' WHEN m <= 15 THEN 'medium' ELSE 'long' END AS slice, y_true, y_prob FROM lens),
      {curve('slice')}, {metrics(0.01, 'slice')} SELECT * FROM metrics""",
    "split_gap": f"""WITH {SCORED_DOCS.replace('scored AS', 'base AS')}, scored AS (SELECT *, {split_of('id')} AS split FROM base), {curve('split')}, {metrics(0.5, 'split')}
      SELECT {', '.join(f"round(max({n}) FILTER (split = 'train') - max({n}) FILTER (split = 'test'), 4) AS {n}_gap" for n in ('precision', 'recall', 'f1', 'auc_roc', 'avg_precision'))} FROM metrics""",
    "top_errors": f"""WITH {SCORED_PAIRS}, wrong AS (SELECT *, CASE WHEN y_true = 0 THEN 'false_positive' ELSE 'false_negative' END AS error_type FROM scored
      WHERE (y_true = 0 AND y_prob >= 0.01) OR (y_true = 1 AND y_prob < 0.01)),
      placed AS (SELECT *, row_number() OVER (PARTITION BY error_type ORDER BY CASE WHEN y_true = 0 THEN -y_prob ELSE y_prob END, id)::INT AS rank FROM wrong)
      SELECT error_type, rank, id, y_true, y_prob FROM placed WHERE rank <= 10""",
    "errors_at_best_threshold": f"""WITH {SCORED_PAIRS}, {curve()}, f AS (SELECT threshold, tp::DOUBLE / (tp + fp) AS p, tp::DOUBLE / n_pos AS r FROM curve),
      g AS (SELECT threshold, round(2 * p * r / (p + r + 1e-8), 9) AS f1 FROM f), best AS (SELECT threshold FROM g ORDER BY f1 DESC, threshold LIMIT 1),
      wrong AS (SELECT scored.*, threshold, CASE WHEN y_true = 0 THEN 'false_positive' ELSE 'false_negative' END AS error_type FROM scored, best
        WHERE (y_true = 0 AND y_prob >= threshold) OR (y_true = 1 AND y_prob < threshold)),
      placed AS (SELECT *, row_number() OVER (PARTITION BY error_type ORDER BY CASE WHEN y_true = 0 THEN -y_prob ELSE y_prob END, id)::INT AS rank FROM wrong)
      SELECT error_type, rank, id, y_true, y_prob, threshold FROM placed WHERE rank <= 10""",
    "class_weights": f"""WITH {PAIRS}, c AS (SELECT count(*) FILTER (is_duplicate = 0) AS n_neg, count(*) FILTER (is_duplicate = 1) AS n_pos FROM pairs WHERE known)
      SELECT n_neg, n_pos, round(n_neg::DOUBLE / n_pos, 6) AS positive_weight, round((n_neg + n_pos) / (2.0::DOUBLE * n_neg), 6) AS balanced_neg,
      round((n_neg + n_pos) / (2.0::DOUBLE * n_pos), 6) AS balanced_pos FROM c""",
    "golden_accuracy": f"""WITH {PAIRS}, g AS (SELECT d.lang AS category, (({cosine('a.embedding', 'b.embedding')} >= 0.5)::INT = is_duplicate)::INT AS ok
        FROM pairs JOIN embeddings a ON a.vec_id = qid1 JOIN embeddings b ON b.vec_id = qid2 JOIN documents d ON d.doc_id = qid1)
      SELECT category, count(*) AS n, round(avg(ok), 4) AS accuracy FROM g GROUP BY category UNION ALL SELECT 'overall', count(*), round(avg(ok), 4) FROM g""",
    "pair_cosine_threshold": f"""WITH {PAIRS}, scored AS (SELECT is_duplicate AS y_true, round({cosine('a.embedding', 'b.embedding')}, 6) AS y_prob
        FROM pairs JOIN embeddings a ON a.vec_id = qid1 JOIN embeddings b ON b.vec_id = qid2 WHERE known), {curve()},
      f AS (SELECT threshold, tp::DOUBLE / (tp + fp) AS p, tp::DOUBLE / n_pos AS r FROM curve),
      g AS (SELECT threshold, round(2 * p * r / (p + r + 1e-8), 9) AS f1 FROM f) SELECT threshold, round(f1, 4) AS f1 FROM g ORDER BY g.f1 DESC, threshold LIMIT 1""",
    "retrieval_quality": f"""WITH {PAIRS}, truth AS (SELECT qid1 AS query_id, qid2 AS relevant_id FROM pairs WHERE is_duplicate = 1 UNION SELECT qid2, qid1 FROM pairs WHERE is_duplicate = 1),
      queries AS (SELECT DISTINCT query_id FROM truth WHERE query_id IN (SELECT vec_id FROM embeddings)),
      {knn('SELECT query_id, embedding AS v FROM queries JOIN embeddings ON vec_id = query_id', 10)},
      first AS (SELECT q.query_id, min(h.rank) AS f FROM queries q LEFT JOIN (SELECT hits.query_id, rank FROM hits JOIN truth t ON t.query_id = hits.query_id AND relevant_id = question_id) h
        ON h.query_id = q.query_id GROUP BY 1)
      SELECT count(*) AS n_queries, {', '.join(f'round(avg(CASE WHEN f <= {k} THEN 1.0::DOUBLE ELSE 0 END), 4) AS recall_at_{k}' for k in (1, 5, 10))},
      round(avg(coalesce(1.0::DOUBLE / f, 0)), 4) AS mrr FROM first""",
    "retrieval_by_label": f"""WITH {knn(SELF, 10, 'hits', 'WHERE vec_id <> query_id')},
      first AS (SELECT e.vec_id, min(CASE WHEN t.label = e.label THEN rank END) AS f FROM embeddings e LEFT JOIN hits ON query_id = e.vec_id LEFT JOIN embeddings t ON t.vec_id = question_id GROUP BY 1)
      SELECT count(*) AS n_queries, {', '.join(f'round(avg(CASE WHEN f <= {k} THEN 1.0::DOUBLE ELSE 0 END), 4) AS recall_at_{k}' for k in (1, 5, 10))},
      round(avg(coalesce(1.0::DOUBLE / f, 0)), 4) AS mrr FROM first""",
    "class_balance": f"WITH {SPLIT} SELECT split, count(*) AS n, sum(is_duplicate)::BIGINT AS n_positive, round(avg(is_duplicate), 4) AS positive_rate FROM splits GROUP BY split",
    "label_shares": f"""WITH {PAIRS} SELECT is_duplicate, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM pairs WHERE known), 3) AS share FROM pairs WHERE known GROUP BY 1""",
    "length_histogram": f"""WITH {PAIRS}, s AS (SELECT is_duplicate, 'q1' AS side, {n_words('question1')} AS w FROM pairs UNION ALL SELECT is_duplicate, 'q2', {n_words('question2')} FROM pairs)
      SELECT is_duplicate, side, least(w, 50) AS n_words, count(*) AS n FROM s GROUP BY ALL""",
    "length_quantiles": f"""WITH {PAIRS}, s AS (SELECT is_duplicate, 'q1' AS side, {n_words('question1')} AS w FROM pairs UNION ALL SELECT is_duplicate, 'q2', {n_words('question2')} FROM pairs)
      SELECT is_duplicate, side, quantile_cont(w, 0.25)::DOUBLE AS p25, quantile_cont(w, 0.5)::DOUBLE AS p50, quantile_cont(w, 0.75)::DOUBLE AS p75 FROM s GROUP BY ALL""",
    "jaccard_by_class": f"WITH {PAIRS} SELECT is_duplicate, count(*) AS n, round(avg({jaccard('question1', 'question2')}), 3) AS mean_jaccard FROM pairs GROUP BY 1",
    "hard_negatives": f"WITH {PAIRS}, j AS (SELECT *, {jaccard('question1', 'question2')} AS j FROM pairs) SELECT pair_id, round(j, 6) AS jaccard FROM j WHERE j > 0.1 AND is_duplicate = 0",
    "top_bigrams": f"""WITH {PAIRS}, d AS (SELECT is_duplicate, question1 AS t FROM pairs UNION ALL SELECT is_duplicate, question2 FROM pairs),
      w AS (SELECT is_duplicate, list_filter(regexp_extract_all(lower(t), '{W}{{2,}}'), lambda x: NOT list_contains({BIGRAM_STOP}, x)) AS w FROM d),
      g AS (SELECT is_duplicate, unnest(list_transform(list_zip(w[:-2], w[2:]), lambda z: z[1] || ' ' || z[2])) AS bigram FROM w),
      c AS (SELECT is_duplicate, bigram, count(*) AS n FROM g GROUP BY ALL)
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY is_duplicate ORDER BY n DESC, bigram)::INT AS rank FROM c) WHERE rank <= 15""",
    "duplicate_pairs": f"WITH {SPLIT} {DUPLICATES}",
    "blank_counts": f"""WITH {RAW} SELECT 'question1' AS column_name, count(*) FILTER (t1 IS NULL) AS n_null, count(*) FILTER (length({strip('t1')}) = 0) AS n_blank FROM raw
      UNION ALL SELECT 'question2', count(*) FILTER (t2 IS NULL), count(*) FILTER (length({strip('t2')}) = 0) FROM raw""",
    "pair_leakage": f"WITH {SPLIT} SELECT n AS n_shared FROM ({LEAKED})",
    "question_overlap": f"WITH {SPLIT}, {SEEN} SELECT n_test, n_shared, round(overlap, 6) AS overlap FROM seen",
    "quality_report": f"""WITH {SPLIT}, {SEEN}, dup AS ({DUPLICATES})
      SELECT 'blank_texts' AS check, 'question1' AS split, 0.0::DOUBLE AS value, '= 0' AS bound, true AS passed
      UNION ALL SELECT 'blank_texts', 'question2', 0.0, '= 0', true
      UNION ALL SELECT 'duplicate_pairs', split, n_duplicates::DOUBLE, '<= 100', n_duplicates <= 100 FROM dup
      UNION ALL SELECT 'positive_rate', split, round(avg(is_duplicate), 6), '0.25 .. 0.5', avg(is_duplicate) BETWEEN 0.25 AND 0.5 FROM splits GROUP BY split
      UNION ALL SELECT 'pair_leakage', 'train/test', n::DOUBLE, '<= 300', n <= 300 FROM ({LEAKED})
      UNION ALL SELECT 'question_overlap', 'train/test', round(overlap, 6), '< 0.45', overlap < 0.45 FROM seen""",
    "validate_requests": f"""WITH r AS (SELECT conv_id, turn, text, CASE WHEN turn > 0 THEN (turn * 8)::INT ELSE 5 END AS top_k, CASE WHEN turn > 0 THEN turn / 2.0::DOUBLE ELSE 0.3::DOUBLE END AS score_threshold FROM conversations)
      SELECT conv_id, turn, {strip('text')} AS question, top_k, score_threshold, concat_ws(',', CASE WHEN length(text) < 3 THEN 'question_too_short' END,
      CASE WHEN length(text) > 1000 THEN 'question_too_long' END, CASE WHEN length({strip('text')}) = 0 THEN 'question_blank' END,
      CASE WHEN top_k NOT BETWEEN 1 AND 20 THEN 'top_k_out_of_range' END, CASE WHEN score_threshold NOT BETWEEN 0 AND 1 THEN 'threshold_out_of_range' END) AS reasons FROM r""",
    "validate_batches": "SELECT source AS batch_id, count(*) AS n_items, CASE WHEN count(*) > 100 THEN 'batch_too_large' ELSE '' END AS reasons FROM documents GROUP BY source",
    "validate_feedback": f"""WITH {FEEDBACK} SELECT CASE WHEN {VALID} THEN '' ELSE 'rating_out_of_range' END AS reasons, count(*) AS n, sum(is_relevant)::BIGINT AS n_relevant FROM feedback GROUP BY 1""",
    "feedback_rates": FEEDBACK_RATES,
    "feedback_stream": FEEDBACK_RATES,
    "request_summary": f"""WITH {REQUEST_LOG} SELECT count(*) AS total_requests, count(*) FILTER (was_cached) AS cache_hits, count(*) FILTER (NOT was_cached) AS cache_misses,
      round(avg(was_cached::INT), 4) AS cache_hit_rate, round(avg((status < 400)::INT), 4) AS success_rate, round(quantile_cont(latency_ms, 0.5), 4) AS p50,
      round(quantile_cont(latency_ms, 0.95), 4) AS p95, round(quantile_cont(latency_ms, 0.99), 4) AS p99 FROM log""",
    "request_metrics": REQUEST_METRICS,
    "request_metrics_stream": REQUEST_METRICS,
    "click_through": CLICK_THROUGH,
    "click_through_stream": CLICK_THROUGH,
    "ingest_stream": f"""WITH v AS (SELECT doc_id, {strip('text')} AS question_text FROM documents WHERE length(text) BETWEEN 3 AND 1000 AND length({strip('text')}) > 0)
      SELECT row_number() OVER (ORDER BY doc_id) AS question_id, question_text, row_number() OVER (ORDER BY doc_id) - 1 AS vec_id FROM v""",
    "drift_report": f"""WITH {CENTER} SELECT round(avg({dot('embedding', 'c')}), 4) AS mean_similarity, avg({dot('embedding', 'c')}) < 0.7 AS drift_detected, 0.7::DOUBLE AS threshold,
      count(*) AS n_new_questions FROM embeddings, center_list""",
    "drift_by_window": f"""WITH {CENTER} SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, round(avg({dot('embedding', 'c')}), 4) AS mean_similarity,
      avg({dot('embedding', 'c')}) < 0.7 AS drift_detected, count(*) AS n_new_questions FROM embeddings JOIN events ON event_id = vec_id, center_list GROUP BY 1""",
    "upsert_latest": """WITH newest AS (SELECT conv_id, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id)
      SELECT doc_id AS question_id, text AS question_text FROM documents WHERE doc_id NOT IN (SELECT conv_id FROM newest) UNION ALL SELECT conv_id, text FROM newest""",
    "index_reconcile": """SELECT (SELECT count(*) FROM documents) AS n_questions, (SELECT count(*) FROM embeddings) AS n_vectors,
      (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)) AS without_vector,
      (SELECT count(*) FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM documents)) AS without_question, 0::BIGINT AS repeated_ids""",
    "unmatched_ids": """SELECT doc_id AS id, 'vectors' AS missing_in FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)
      UNION ALL SELECT vec_id, 'questions' FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM documents)""",
    "vector_id_remap": "SELECT doc_id AS question_id, vec_id, 'initial' AS source FROM documents LEFT JOIN embeddings ON vec_id = doc_id",
    "rebuild_and_grow": """WITH c AS (SELECT (SELECT count(*) FROM documents) AS built_n, (SELECT count(*) FROM (SELECT doc_id FROM documents UNION SELECT item_id FROM benchmark)) + (SELECT count(*) FROM conversations) AS n)
      SELECT built_n, n, round((n - built_n)::DOUBLE / built_n, 6) AS growth, (n - built_n)::DOUBLE / built_n > 0.1 AS rebuild FROM c""",
    "csv_round_trip": "SELECT doc_id AS question_id, text AS question_text FROM documents",
    "split_files": f"WITH {SPLIT} SELECT pair_id, qid1, qid2, is_duplicate FROM splits WHERE split = 'test'",
}

_RETRIEVAL = ("n_queries", "recall_at_1", "recall_at_5", "recall_at_10", "mrr")
_OVERALL = ("n", "precision", "recall", "f1", "auc_roc", "avg_precision")
_RATES = _OVERALL[1:]
_SPLIT_SCORES = f"{SCORED_PAIRS.replace('scored AS', 'base AS')}, parted AS (SELECT *, {split_of('id')} AS split FROM base)"
_TEST_SCORES = f"{_SPLIT_SCORES}, scored AS (SELECT * FROM parted WHERE split = 'test')"
ORACLES["deep_evaluation"] = f"""WITH test AS (WITH {_TEST_SCORES}, {curve()}, {metrics(0.01)} SELECT * FROM metrics),
  sliced AS (WITH {_SPLIT_SCORES}, lens AS (SELECT *, ({n_words('question1')} + {n_words('question2')}) / 2.0 AS m FROM parted WHERE split = 'test'),
    scored AS (SELECT CASE WHEN m < 8 THEN 'short' WHEN m <= 15 THEN 'medium' ELSE 'long' END AS slice, y_true, y_prob FROM lens),
    {curve('slice')}, {metrics(0.01, 'slice')} SELECT * FROM metrics),
  gap AS (WITH {_SPLIT_SCORES}, scored AS (SELECT * FROM parted), {curve('split')}, {metrics(0.01, 'split')}
    SELECT {', '.join(f"round(max({n}) FILTER (split = 'train') - max({n}) FILTER (split = 'val'), 4) AS {n}_gap" for n in _RATES)} FROM metrics),
  errors AS (WITH {_TEST_SCORES}, wrong AS (SELECT *, CASE WHEN y_true = 0 THEN 'false_positive' ELSE 'false_negative' END AS error_type FROM scored
      WHERE (y_true = 0 AND y_prob >= 0.01) OR (y_true = 1 AND y_prob < 0.01)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY error_type ORDER BY CASE WHEN y_true = 0 THEN -y_prob ELSE y_prob END, id)::INT AS rank FROM wrong)
    SELECT * FROM placed WHERE rank <= 5),
  found AS ({ORACLES['retrieval_quality']})
  {' UNION ALL '.join([f"SELECT 'overall' AS part, '' AS item, '{m}' AS metric, {m}::DOUBLE AS value FROM test" for m in _OVERALL]
                      + [f"SELECT 'slices', slice, '{m}', {m}::DOUBLE FROM sliced" for m in _OVERALL]
                      + [f"SELECT 'gap', '', '{m}_gap', {m}_gap::DOUBLE FROM gap" for m in _RATES]
                      + [f"SELECT 'errors', error_type || ' ' || rank, '{m}', {m}::DOUBLE FROM errors" for m in ('id', 'y_true', 'y_prob')]
                      + [f"SELECT 'retrieval', '', '{m}', {m}::DOUBLE FROM found" for m in _RETRIEVAL])}"""
