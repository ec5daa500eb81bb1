"""Registered clustering and cluster-description queries.

The k-means queries (``cluster_*``, ``choose_k``, ``cluster_report``) have no SQL
oracle: the fit is iterative and its labels are engine-specific, so they are
checked by row counts, by ``embedding_fit_checks`` (what holds for any right fit, in
SQL) and by invariants in the tests.  The description
operators are checked in SQL with ``documents.lang`` standing in for the
cluster label, and the reply parser on the assistant turns of ``conversations``.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from feedlens.functions.text import clean_text
from feedlens.functions.weights import with_weights
from feedlens.operators import analysis as AN
from feedlens.operators import cluster as C
from feedlens.operators import kmeans_long
from feedlens.operators import report as R
from feedlens.operators.text import TERMS_MAX_DF, VECTOR_MAX_DF, tfidf_long
from feedlens.plans.oracle_views import with_views
from feedlens.plans.text import tfidf_sql_ctes
from feedlens.session import written
from feedlens.sources.feedback import feedback_from_tables
from feedlens.sources.tables import Tables
QUERIES: dict = {}
ORACLES: dict[str, str] = {}

# Fixed parameters of the registered queries: a corpus lexicon whose cues occur in
# the benchmark prose (the stock cues are tested on literal fixtures instead).
CORPUS_LEXICON = (
    ("Bug", r"that|with"),
    ("Feature Request", r"avec|pour"),
    ("Documentation/Clarity", r"und|ein"),
    ("Performance/Quality", r"los|las"),
    ("Configuration/Usability", r"zzz"),
)
SAMPLES = 3
PROMPT_LINES = 20
PROMPT_BUCKET_LINES = 500


def _members(spark, sf_dir):
    """Feedback rows with cleaned text and the language as cluster stand-in."""
    fb = feedback_from_tables(spark, sf_dir)
    return (fb.withColumn("_text", clean_text("request")).filter(F.col("_text").isNotNull())
            .withColumn("line", R.example_line(fb, "request")))


def _sql_str(s: str) -> str:
    parts = s.split("\n")
    return " || chr(10) || ".join("'" + p.replace("'", "''") + "'" for p in parts)


_CLEAN = r"regexp_replace(request, '^\s+|\s+$', '', 'g')"
_MEMBERS_SQL = f"""
m AS (SELECT doc_id, lang, {_CLEAN} AS text,
             CASE WHEN nullif(trim(customer), '') IS NOT NULL
                  THEN trim(customer) || ': ' || {_CLEAN} ELSE {_CLEAN} END AS line
      FROM feedback WHERE length({_CLEAN}) > 0)"""


# -- intents: P20 P22 A9 ---------------------------------------------------------------
def intents(spark, sf_dir):
    return R.cluster_intents(_members(spark, sf_dir), "lang", "_text", CORPUS_LEXICON)


QUERIES["intents"] = intents
_flags = [(R._flag_name(label), pat, label) for label, pat in CORPUS_LEXICON]
ORACLES["intents"] = with_views(["feedback"], "") + ", " + _MEMBERS_SQL.strip() + """,
g AS (SELECT lang, """ + ",\n       ".join(
    f"bool_or(regexp_matches(lower(text), '{pat}')) AS {name}" for name, pat, _ in _flags) + """,
       bool_or(""" + " OR ".join(f"contains(lower(text), '{cue}')" for cue in R.FRUSTRATION_CUES) + """) AS frustrated
      FROM m GROUP BY lang)
SELECT *, concat_ws(', ', """ + ", ".join(
    f"CASE WHEN {name} THEN '{label}' END" for name, _, label in _flags) + """) AS intents,
       CASE WHEN frustrated THEN '""" + R.TONE_FRUSTRATION + "' ELSE '" + R.TONE_DESIRE + """' END AS tone
FROM g"""


# -- examples: T5 P11 ------------------------------------------------------------------
def examples(spark, sf_dir):
    return R.cluster_examples(_members(spark, sf_dir), "lang", "line", SAMPLES)


QUERIES["examples"] = examples
ORACLES["examples"] = with_views(["feedback"], "") + ", " + _MEMBERS_SQL.strip() + f""",
d AS (SELECT DISTINCT lang, line FROM m),
r AS (SELECT lang, line, row_number() OVER (PARTITION BY lang ORDER BY length(line), line) AS rank FROM d)
SELECT lang, rank, line FROM r WHERE rank <= {SAMPLES}"""


# -- representatives: M9 -----------------------------------------------------------------
def representatives(spark, sf_dir):
    return R.representatives(_members(spark, sf_dir), "lang", "_text")


QUERIES["representatives"] = representatives
ORACLES["representatives"] = with_views(["feedback"], "") + ", " + _MEMBERS_SQL.strip() + """,
r AS (SELECT lang, text, row_number() OVER (PARTITION BY lang ORDER BY length(text), text) AS rn FROM m)
SELECT lang, text AS representative FROM r WHERE rn = 1"""


# -- cluster_prompts: P24 -----------------------------------------------------------------
def cluster_prompts(spark, sf_dir):
    m = _members(spark, sf_dir)
    return R.cluster_prompts(m, "lang", "_text", None, PROMPT_LINES, "doc_id", PROMPT_BUCKET_LINES)


_head, _tail = R.DEFAULT_PROMPT.split("{joined}")
QUERIES["cluster_prompts"] = cluster_prompts
ORACLES["cluster_prompts"] = with_views(["feedback"], "") + ", " + _MEMBERS_SQL.strip() + f""",
b AS (SELECT lang, text, doc_id, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT)
             % CAST(ceil(count(*) OVER (PARTITION BY lang) / {PROMPT_BUCKET_LINES}) AS BIGINT) AS bucket
      FROM m),
r AS (SELECT lang, bucket, text, row_number() OVER (PARTITION BY lang, bucket ORDER BY length(text), text, doc_id) AS rank
      FROM b),
j AS (SELECT lang, bucket, CAST(ceil(rank / {PROMPT_LINES}) AS BIGINT) AS part, count(*) AS n_lines,
             string_agg('- ' || text, chr(10) ORDER BY rank) AS joined
      FROM r GROUP BY 1, 2, 3)
SELECT lang, bucket, part, n_lines, {_sql_str(_head)} || joined || {_sql_str(_tail)} || {_sql_str(R.PROMPT_SUFFIX)} AS prompt
FROM j"""


# -- cluster_members: K2 K4, every row of a group -------------------------------------------
def cluster_members(spark, sf_dir):
    m = _members(spark, sf_dir)
    sizes = m.groupBy("lang").agg(F.count(F.lit(1)).alias("count"))
    return R.cluster_members(m, R.ranked(sizes, "lang"), "lang", "doc_id", "line")


QUERIES["cluster_members"] = cluster_members
ORACLES["cluster_members"] = with_views(["feedback"], "") + ", " + _MEMBERS_SQL.strip() + """,
k AS (SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) AS rank FROM m GROUP BY lang)
SELECT CAST(k.rank AS INTEGER) AS rank, m.lang, m.doc_id, m.line FROM m JOIN k ON m.lang = k.lang"""


# -- parsed_json_replies: P25, the JSON branch over every turn --------------------------------
def parsed_json_replies(spark, sf_dir):
    turn = F.col("turn").cast("string")
    reply = F.concat(F.lit('Answer: {"title": " Turn '), turn, F.lit('", "summary": "'), F.col("role"),
                     F.lit('", "representative": "'), F.col("conv_id").cast("string"), F.lit('"} end'))
    conv = Tables(spark, sf_dir).conversations.select("conv_id", "turn", reply.alias("reply"))
    return R.parse_replies(conv, "reply").drop("reply")


QUERIES["parsed_json_replies"] = parsed_json_replies
ORACLES["parsed_json_replies"] = """
SELECT conv_id, turn, 'Turn ' || CAST(turn AS VARCHAR) AS title, role AS summary,
       CAST(conv_id AS VARCHAR) AS representative FROM conversations"""


# -- parsed_replies: P25 P26 (assistant turns of conversations) -----------------------------
def parsed_replies(spark, sf_dir):
    conv = Tables(spark, sf_dir).conversations
    parsed = R.parse_replies(conv.filter(F.col("role") == "assistant")
                             .select("conv_id", "turn", "text"), "text").drop("text")
    users = (conv.filter(F.col("role") == "user")
             .withColumn("_t", clean_text("text")).filter(F.col("_t").isNotNull()))
    defaults = (R.representatives(users, "conv_id", "_t")
                .withColumn("title", R.default_title(F.array().cast("array<string>"))))
    return R.with_fallbacks(parsed, defaults, "conv_id").select(
        "conv_id", "turn", "title", "summary", "representative")


_WS = r"'^\s+|\s+$'"
_BR = r"'\r\n|[\n\r\x{0b}\x{0c}\x{1c}\x{1d}\x{1e}\x{85}\x{2028}\x{2029}]'"
QUERIES["parsed_replies"] = parsed_replies
ORACLES["parsed_replies"] = rf"""
WITH a AS (SELECT conv_id, turn, coalesce(text, '') AS raw FROM conversations WHERE role = 'assistant'),
j AS (SELECT *, regexp_extract(raw, '(?s)\{{.*\}}', 0) AS js FROM a),
o AS (SELECT *, CASE WHEN js <> '' AND json_valid(js) THEN js END AS jv FROM j),
p AS (SELECT conv_id, turn, raw,
             regexp_replace(coalesce(json_extract_string(jv, '$.title'), ''), {_WS}, '', 'g') AS jt,
             regexp_replace(coalesce(json_extract_string(jv, '$.summary'), ''), {_WS}, '', 'g') AS js2,
             regexp_replace(coalesce(json_extract_string(jv, '$.representative'), ''), {_WS}, '', 'g') AS jr,
             list_filter(list_transform(regexp_split_to_array(raw, {_BR}),
                                        lambda x: regexp_replace(x, {_WS}, '', 'g')),
                         lambda x: length(x) > 0) AS lines
      FROM o),
q AS (SELECT conv_id, turn,
             CASE WHEN length(jt) + length(js2) + length(jr) > 0 THEN jt
                  ELSE coalesce(regexp_replace(lines[1], ':+$', ''), '') END AS title,
             CASE WHEN length(jt) + length(js2) + length(jr) > 0 THEN js2
                  ELSE regexp_replace(array_to_string(lines[2:], chr(10)), {_WS}, '', 'g') END AS summary,
             CASE WHEN length(jt) + length(js2) + length(jr) > 0 THEN jr ELSE '' END AS representative
      FROM p),
u AS (SELECT conv_id, regexp_replace(text, {_WS}, '', 'g') AS t FROM conversations WHERE role = 'user'),
d AS (SELECT conv_id, t, row_number() OVER (PARTITION BY conv_id ORDER BY length(t), t) AS rn
      FROM u WHERE length(t) > 0)
SELECT q.conv_id, q.turn,
       coalesce(nullif(q.title, ''), 'Theme') AS title,
       q.summary AS summary,
       coalesce(nullif(q.representative, ''), d.t, '') AS representative
FROM q LEFT JOIN d ON q.conv_id = d.conv_id AND d.rn = 1"""


# -- described_groups: A8 T3 T4 M8-M10 P20-P23 P25 P26, languages in the place of clusters ----
def _described(spark, sf_dir):
    fb = feedback_from_tables(spark, sf_dir)
    rows = (fb.withColumn("_text", clean_text("request")).filter(F.col("_text").isNotNull())
            .withColumn("_row", F.col("doc_id")))
    assignment = rows.select(F.col("_row").alias("doc_id"), F.col("lang").alias("cluster"))
    replies = (assignment.groupBy("cluster").agg(F.min("doc_id").alias("_first"))
               .select("cluster", F.when(F.col("_first") % 2 == 0, F.concat(
                   F.lit('{"title": "Group '), F.col("cluster"), F.lit('", "summary": " "}'))).alias("reply")))
    return AN.describe(rows, assignment, "request", samples=SAMPLES, replies=replies)


def described_groups(spark, sf_dir):
    report, _ = _described(spark, sf_dir)
    return report.withColumns({c: F.array_join(c, " | ") for c in ("terms", "examples")})


_stock = [(pattern.replace("'", "''"), label) for label, pattern in R.STOCK_INTENTS]
_cues = " OR ".join(f"contains(lower(text), '{cue}')" for cue in R.FRUSTRATION_CUES)
_before, _rest = R.SUMMARY_TEMPLATE.split("{terms}")
_between, _rest = _rest.split("{intents}")
_ahead, _after = _rest.split("{tone}")
_DESCRIBED_SQL = with_views(["feedback"], "") + ", " + _MEMBERS_SQL.strip() + "," + \
    tfidf_sql_ctes((TERMS_MAX_DF,)) + f""",
sizes AS (SELECT lang, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, lang) AS rank,
                 min(doc_id) AS first FROM m GROUP BY lang),
sums AS (SELECT m.lang, t.term, sum(t.tfidf) AS s FROM tfidf t JOIN m ON t.doc_id = m.doc_id GROUP BY 1, 2),
best AS (SELECT s.lang, s.term, row_number() OVER (PARTITION BY s.lang ORDER BY round(s.s / z.count, 9) DESC, s.term) AS r
         FROM sums s JOIN sizes z ON s.lang = z.lang),
terms8 AS (SELECT lang, list(term ORDER BY r) AS t FROM best WHERE r <= 8 GROUP BY lang),
flags AS (SELECT lang, concat_ws(', ', """ + ", ".join(
    f"CASE WHEN bool_or(regexp_matches(lower(text), '{p}')) THEN '{label}' END" for p, label in _stock) + f""") AS intents,
                 CASE WHEN bool_or({_cues}) THEN '{R.TONE_FRUSTRATION}' ELSE '{R.TONE_DESIRE}' END AS tone
          FROM m GROUP BY lang),
short AS (SELECT lang, line, row_number() OVER (PARTITION BY lang ORDER BY length(line), line) AS r
          FROM (SELECT DISTINCT lang, line FROM m) d),
ex AS (SELECT lang, string_agg(line, ' | ' ORDER BY r) AS examples FROM short WHERE r <= {SAMPLES} GROUP BY lang),
rep AS (SELECT lang, text, row_number() OVER (PARTITION BY lang ORDER BY length(text), text) AS r FROM m)
SELECT CAST(z.rank AS INTEGER) AS rank, z.lang AS cluster, z.count,
       array_to_string(t.t, ' | ') AS terms, ex.examples,
       '{_before}' || coalesce(array_to_string(t.t[1:{R.SUMMARY_TERMS}], ', '), '{R.NO_TERMS}') || '{_between}'
         || coalesce(nullif(f.intents, ''), '{R.NO_INTENT}') || '{_ahead}' || f.tone || '{_after}' AS summary,
       CASE WHEN z.first % 2 = 0 THEN 'Group ' || z.lang
            ELSE '{R.TITLE_PREFIX}: ' || array_to_string(t.t[1:{R.TITLE_TERMS}], ', ') END AS title,
       rep.text AS representative
FROM sizes z JOIN terms8 t ON z.lang = t.lang JOIN flags f ON z.lang = f.lang JOIN ex ON z.lang = ex.lang
JOIN rep ON z.lang = rep.lang AND rep.r = 1"""
QUERIES["described_groups"] = described_groups
ORACLES["described_groups"] = _DESCRIBED_SQL


# -- clean_embeddings: M3, a NaN and an infinity put into each vector --------------------------
def clean_embeddings(spark, sf_dir):
    emb = Tables(spark, sf_dir).embeddings
    at = F.pmod("vec_id", F.size("embedding"))
    spoilt = F.transform("embedding", lambda x, i: F.when(i == at, F.lit(float("nan")))
                         .when(i == at + 1, F.lit(float("-inf"))).otherwise(x.cast("double")))
    clean = emb.select("vec_id", C.clean_embedding(spoilt).alias("v"))
    return clean.select("vec_id", F.size(F.filter("v", lambda x: x == 0)).cast("bigint").alias("n_zero"),
                        F.round(F.aggregate("v", F.lit(0.0), lambda s, x: s + x), 6).alias("total"))


QUERIES["clean_embeddings"] = clean_embeddings
ORACLES["clean_embeddings"] = """
WITH v AS (SELECT vec_id, list_transform(range(0, len(embedding)), lambda i:
                    CASE WHEN i = vec_id % len(embedding) OR i = vec_id % len(embedding) + 1 THEN 0.0::DOUBLE
                         ELSE embedding[i + 1]::DOUBLE END) AS v FROM embeddings)
SELECT vec_id, len(list_filter(v, lambda x: x = 0)) AS n_zero, round(list_sum(v), 6) AS total FROM v"""


# -- embedding_fit_checks: M4-M6 J11, what holds for any right fit ------------------------------
def embedding_fit_checks(spark, sf_dir):
    """Rows in and out, rows not at their nearest centre, and centres off the mean of their
    rows by more than 0.01 in any coordinate.  The k centres enter as literals."""
    feats = C.materialize(C.embedding_features(Tables(spark, sf_dir).embeddings, "vec_id", "embedding"))
    n = feats.count()
    auto_k, _ = C.choose_k(feats, n=n)
    pred, model = C.cluster(feats, C.k_policy(n, None, auto_k))
    centres = [[float(x) for x in c] for c in model.clusterCenters()]
    far = [F.aggregate(F.zip_with("v", F.array(*map(F.lit, c)), lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                       lambda s, x: s + x) for c in centres]
    rows = pred.select("id", "cluster", vector_to_array("features").alias("v")).withColumn("far", F.array(*far))
    misplaced = F.get("far", F.col("cluster")) > F.array_min("far") + 1e-9
    means = (rows.select("cluster", F.posexplode("v")).groupBy("cluster", "pos").agg(F.avg("col").alias("mean"))
             .withColumn("centre", F.get(F.get(F.array(*[F.array(*map(F.lit, c)) for c in centres]), F.col("cluster")),
                                         F.col("pos"))))
    off = means.filter(F.abs(F.col("mean") - F.col("centre")) > 0.01).select(F.count(F.lit(1))).scalar()
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("id").alias("n_ids"),
                    F.count_if(misplaced).alias("n_misplaced")).withColumn("n_centres_off", off)


QUERIES["embedding_fit_checks"] = embedding_fit_checks
ORACLES["embedding_fit_checks"] = """
SELECT count(*) AS n_rows, count(DISTINCT vec_id) AS n_ids, 0::BIGINT AS n_misplaced, 0::BIGINT AS n_centres_off
FROM embeddings"""


# -- embedded_requests: S7 (requests with their precomputed embedding, if any) -------------------
def embedded_requests(spark, sf_dir):
    t = Tables(spark, sf_dir)
    placed = C.with_embeddings(t.documents.select("doc_id"), t.embeddings, "doc_id", "vec_id", "embedding")
    v = F.when(F.col("features").isNotNull(), vector_to_array(F.coalesce("features", array_to_vector(F.array(F.lit(0.0))))))
    return placed.select("doc_id", F.size(v).cast("bigint").alias("n_dims"), F.round(F.aggregate(v, F.lit(0.0), lambda s, x: s + x), 5).alias("total"))


QUERIES["embedded_requests"] = embedded_requests
ORACLES["embedded_requests"] = """
WITH e AS (SELECT vec_id, min(embedding) AS v FROM embeddings GROUP BY vec_id)
SELECT d.doc_id, len(e.v) AS n_dims, round(list_sum(CAST(e.v AS DOUBLE[])), 5) AS total
FROM documents d LEFT JOIN e ON d.doc_id = e.vec_id"""


# -- analysis_modes: M11 P10 (embeddings where every row has one, else TF-IDF for all) -------------
def analysis_modes(spark, sf_dir):
    fb, emb = feedback_from_tables(spark, sf_dir), Tables(spark, sf_dir).embeddings
    rows = []
    for name, some in (("all", fb), ("embedded", fb.join(emb.select(F.col("vec_id").alias("_v")).distinct(), F.col("doc_id") == F.col("_v"), "left_semi"))):
        p = AN.prepare(some, "doc_id", "request", emb, terms=False)
        rows.append((name, p.vec_mode, p.n, p.weighted))
        p.features.unpersist()
    return spark.createDataFrame(rows, "selection string, vec_mode string, n_rows bigint, weighted boolean")


QUERIES["analysis_modes"] = analysis_modes
ORACLES["analysis_modes"] = with_views(["feedback"], "") + ", " + _MEMBERS_SQL.strip() + """,
e AS (SELECT DISTINCT vec_id FROM embeddings),
x AS (SELECT 'all' AS selection, m.doc_id, e.vec_id FROM m LEFT JOIN e ON m.doc_id = e.vec_id
      UNION ALL SELECT 'embedded', m.doc_id, e.vec_id FROM m JOIN e ON m.doc_id = e.vec_id)
SELECT selection, CASE WHEN count(vec_id) = count(*) THEN 'embeddings' ELSE 'tfidf' END AS vec_mode, count(*) AS n_rows, true AS weighted
FROM x GROUP BY selection"""


# -- k_policies: M5 M7 (the K of every group of requests, forced and automatic; none under two texts) --
FORCED_K = 5
POLICY_PARTS = 20


def k_policies(spark, sf_dir):
    """Groups are parts of a language, POLICY_PARTS each at most, of falling size."""
    part = F.floor(F.sqrt(F.pmod("doc_id", F.lit(POLICY_PARTS * POLICY_PARTS)))).cast("int")
    sizes = Tables(spark, sf_dir).documents.groupBy("lang", part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    rows = [(r.lang, r.part, r.n, r.n >= 2, *((C.k_policy(r.n, FORCED_K), C.k_policy(r.n, None, r.n % 12), C.k_policy(r.n, None, None, 3, 6))
                                              if r.n >= 2 else (None, None, None))) for r in sizes]
    return spark.createDataFrame(rows, "lang string, part int, n bigint, enough boolean, forced_k bigint, auto_k bigint, range_k bigint")


def _policy_sql(auto: str, k_min: int, k_max: int) -> str:
    wanted = f"least(greatest(1, n - 1), greatest({C.AUTO_K_FLOOR}, {auto}))"
    return (f"CASE WHEN n < 2 THEN NULL WHEN {wanted} BETWEEN {k_min} AND {k_max} THEN {wanted} "
            f"ELSE least(greatest(2, {k_min}), greatest(2, least({k_max}, n - 1))) END")


QUERIES["k_policies"] = k_policies
ORACLES["k_policies"] = f"""
WITH g AS (SELECT lang, CAST(floor(sqrt(doc_id % {POLICY_PARTS * POLICY_PARTS})) AS INTEGER) AS part, count(*) AS n FROM documents GROUP BY 1, 2)
SELECT lang, part, n, n >= 2 AS enough, CASE WHEN n >= 2 THEN least(greatest({FORCED_K}, 1), greatest(1, n - 1)) END AS forced_k,
       {_policy_sql("n % 12", C.DEFAULT_K_MIN, C.DEFAULT_K_MAX)} AS auto_k, {_policy_sql("3", 3, 6)} AS range_k FROM g"""


# -- tfidf_fit_checks: M1 M6 P10 on exact columns, what holds for any right weighted fit -----------
FIT_K = 4


def tfidf_fit_checks(spark, sf_dir):
    """The long-form fit of the request table: documents and terms as they are, documents whose
    distance to another centre is less than to theirs, and centre weights off the weighted mean of
    their documents (both computed anew from the rows, not by the fit's own code)."""
    fb = feedback_from_tables(spark, sf_dir)
    rows = with_weights(fb).withColumn("text", clean_text("request")).filter(F.col("text").isNotNull())
    docs = rows.select("doc_id", "text")
    tfidf = tfidf_long(docs)
    entries = written(tfidf.select(F.col("doc_id").alias("id"), "term", F.col("tfidf").alias("w")), "fit-entries")
    weights = written(rows.select(F.col("doc_id").alias("id"), "weight"), "fit-weights")
    found = kmeans_long.fit(weights, entries, FIT_K)
    placed = found.assignment
    wide = written(found.centres.groupBy("term").agg(
        *[F.coalesce(F.sum(F.when(F.col("cluster") == j, F.col("weight"))), F.lit(0.0)).alias(f"c{j}") for j in range(FIT_K)]), "fit-centres")
    norms = wide.agg(*[F.coalesce(F.sum(F.col(f"c{j}") * F.col(f"c{j}")), F.lit(0.0)) for j in range(FIT_K)]).first()
    products = entries.join(wide, "term").groupBy("id").agg(*[F.sum(F.col("w") * F.col(f"c{j}")).alias(f"d{j}") for j in range(FIT_K)])
    far = F.array(*[F.lit(norms[j]) - 2 * F.coalesce(f"d{j}", F.lit(0.0)) for j in range(FIT_K)])
    mine = placed.join(products, "id", "left").select(F.get(far, F.col("cluster")).alias("own"), F.array_min(far).alias("least"))
    misplaced = mine.filter(F.col("own") > F.col("least") + 1e-6).select(F.count(F.lit(1))).scalar()
    pulls = placed.join(weights, "id").groupBy("id", "cluster").agg(F.sum("weight").alias("weight"))
    totals = {r.cluster: r.total for r in pulls.groupBy("cluster").agg(F.sum("weight").alias("total")).collect()}   # k rows
    by_term = entries.join(pulls, "id", "left").groupBy("term").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.when(F.col("cluster") == j, F.col("w") * F.col("weight"))).alias(f"s{j}") for j in range(FIT_K)])
    gaps = [F.abs(F.coalesce(F.try_divide(f"s{j}", F.lit(totals.get(j))), F.lit(0.0)) - F.coalesce(f"c{j}", F.lit(0.0))) for j in range(FIT_K)]
    terms = by_term.join(wide, "term", "full").agg(
        F.count("n").alias("n_terms"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_entries"),
        *[F.count_if(gap > 0.001).alias(f"off{j}") for j, gap in enumerate(gaps)]).first()
    return placed.agg(F.count(F.lit(1)).alias("n_docs"), F.countDistinct("id").alias("n_ids"), F.countDistinct("cluster").alias("n_clusters")) \
        .withColumns({"n_terms": F.lit(terms.n_terms).cast("bigint"), "n_entries": F.lit(terms.n_entries).cast("bigint"), "n_misplaced": misplaced,
                      "n_centres_off": F.lit(sum(terms[f"off{j}"] for j in range(FIT_K))).cast("bigint")})


QUERIES["tfidf_fit_checks"] = tfidf_fit_checks
ORACLES["tfidf_fit_checks"] = "WITH " + tfidf_sql_ctes((VECTOR_MAX_DF, TERMS_MAX_DF)) + f"""
SELECT (SELECT count(*) FROM docs) AS n_docs, (SELECT count(DISTINCT doc_id) FROM docs) AS n_ids,
       CAST({FIT_K} AS BIGINT) AS n_clusters, (SELECT count(DISTINCT term) FROM tfidf) AS n_terms,
       (SELECT count(*) FROM tfidf) AS n_entries, 0::BIGINT AS n_misplaced, 0::BIGINT AS n_centres_off"""


# -- k-means queries (rows-only check) ------------------------------------------------------
def cluster_embeddings(spark, sf_dir):
    emb = Tables(spark, sf_dir).embeddings
    feats = C.materialize(C.embedding_features(emb, "vec_id", "embedding"))
    n = feats.count()
    auto_k, _ = C.choose_k(feats, n=n)
    k = C.k_policy(n, None, auto_k)
    pred, _ = C.cluster(feats, k)
    out = C.materialize(pred.select(F.col("id").alias("vec_id"), "cluster"), key="vec_id")
    feats.unpersist()
    return out


def _analysis(spark, sf_dir):
    return AN.analyze(feedback_from_tables(spark, sf_dir), id_col="doc_id", text_col="request",
                      samples=SAMPLES)


def cluster_documents(spark, sf_dir):
    return _analysis(spark, sf_dir).assignment


def choose_k(spark, sf_dir):
    k, sweep = AN.sweep_k(feedback_from_tables(spark, sf_dir), id_col="doc_id",
                          text_col="request")
    rows = [(r.k, r.n_clusters, r.min_size, r.silhouette, r.k == k) for r in sweep]
    schema = "k int, n_clusters int, min_size int, silhouette double, chosen boolean"
    return spark.createDataFrame(rows, schema)


def cluster_report(spark, sf_dir):
    return _analysis(spark, sf_dir).report


QUERIES["cluster_embeddings"] = cluster_embeddings
QUERIES["cluster_documents"] = cluster_documents
QUERIES["choose_k"] = choose_k
QUERIES["cluster_report"] = cluster_report
