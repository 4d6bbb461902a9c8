"""Enrichment, similarity search and prompt context."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.operators import enrich, search
from tallyward.operators.pruned_search import InvertedFile
from tallyward.queries.registry import query
from tallyward.sources import model
from tallyward.session import stored_copy
from tallyward.sources.tables import table

_DESCRIBE = """'Describe the ' || CASE WHEN chronic_flag THEN 'chronic' ELSE 'acute' END || ' condition ' || icd10_code || ' ('
    || description || '), category ' || category || ', for a clinician: what it is, its features and its management. '
    || 'At most three sentences, no bullets.'"""
_EXPLAIN = """'Explain code ' || icd10_code || ' (' || description || ') to a patient. Answer as JSON with the keys plain_english, '
    || 'symptoms and treatment, one sentence each.'"""


@query("pending_rows", "diagnosis_dim",
       "SELECT icd10_code, description, category, chronic_flag FROM diagnosis_dim WHERE ai_description IS NULL")
def pending_rows(spark, folder):
    return enrich.pending(model.diagnosis_dim(spark, folder)).orderBy("icd10_code")


@query("enrich_pending", "diagnosis_dim", f"""
    SELECT icd10_code, 'Answer to: ' || {_DESCRIBE} AS ai_description FROM diagnosis_dim WHERE ai_description IS NULL""")
def enrich_pending(spark, folder):
    return enrich.describe_pending(model.diagnosis_dim(spark, folder))


@query("enrich_merge", "diagnosis_dim", f"""
    SELECT icd10_code, description, category, chronic_flag,
           coalesce(ai_description, 'Answer to: ' || {_DESCRIBE}) AS ai_description FROM diagnosis_dim""")
def enrich_merge(spark, folder):
    dim = model.diagnosis_dim(spark, folder)
    return enrich.write_back(dim, stored_copy(enrich.describe_pending(dim), "descriptions"))


@query("enrich_coverage", "diagnosis_dim", """
    SELECT count(*) AS total_codes, count(ai_description) AS enriched_codes, count(*) - count(ai_description) AS pending_codes,
           round(count(ai_description) / count(*) * 100, 1) AS coverage_pct FROM diagnosis_dim""")
def enrich_coverage(spark, folder):
    return enrich.coverage(model.diagnosis_dim(spark, folder))


@query("enrich_preview", "diagnosis_dim", """
    SELECT icd10_code, description, substr(ai_description, 1, 100) AS ai_desc_preview FROM diagnosis_dim
    WHERE ai_description IS NOT NULL""")
def enrich_preview(spark, folder):
    return enrich.preview(model.diagnosis_dim(spark, folder))


@query("json_extract", "diagnosis_dim", f"""
    SELECT icd10_code, description, {_EXPLAIN} AS plain_english, length({_EXPLAIN}) || ' characters' AS symptoms,
           'rest' AS treatment FROM diagnosis_dim WHERE ai_description IS NULL""")
def json_extract(spark, folder):
    return enrich.explain(model.diagnosis_dim(spark, folder))


@query("triage_labels", "er_silver", """
    SELECT admission_id, diagnosis_code, severity, los_hours,
           CASE severity WHEN 5 THEN 'IMMEDIATE' WHEN 4 THEN 'URGENT' ELSE 'LESS_URGENT' END AS priority,
           'severity ' || severity || ' of 5' AS rationale FROM er_silver WHERE severity >= 3""")
def triage_labels(spark, folder):
    return enrich.triage(model.er_silver(spark, folder))


_HISTORY = """
    SELECT patient_id, part, count(*) AS claim_count,
           CAST(to_json(list({claim_date: claim_date, diagnosis_code: diagnosis_code, claim_amount: claim_amount,
                              claim_status: claim_status} ORDER BY n)) AS VARCHAR) AS claims_json
    FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY claim_date, claim_id) AS n,
                 CAST((row_number() OVER (PARTITION BY patient_id ORDER BY claim_date, claim_id) - 1) // 20 AS INTEGER) AS part
          FROM claims_fact) GROUP BY patient_id, part"""


@query("claim_history_json", "claims_fact", _HISTORY)
def claim_history_json(spark, folder):
    return enrich.claim_documents(model.claims_fact(spark, folder), per_part=20).drop("prompt")


@query("claim_history_json_sliced", "claims_fact", _HISTORY)
def claim_history_json_sliced(spark, folder):
    """The same with the patients of 30 or more claims in slices. The claims
    are stored, as slicing reads them several times."""
    busy = stored_copy(model.busy_patients(spark, folder, 30), "busy")
    named = ["patient_id", "claim_id", "claim_date", "diagnosis_code", "claim_amount", "claim_status"]
    facts = stored_copy(model.claims_fact(spark, folder).select(*named), "history-facts")
    return enrich.claim_documents(facts, per_part=20, hot=busy).drop("prompt")


@query("event_properties", "", """
    SELECT event_id, CAST(props ->> '$.k' AS INTEGER) AS k, props ->> '$.k' AS k_text FROM events""")
def event_properties(spark, folder):
    return table(spark, folder, "events").select(
        "event_id",
        F.from_json("props", "k INT")["k"].alias("k"),
        F.get_json_object("props", "$.k").alias("k_text"),
    )


# Search: diagnosis codes with vectors form the index; the questions are the
# mean vectors of the labels.
def diagnosis_index(spark, folder):
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").cast("string").alias("icd10_code"), "embedding")
    return model.diagnosis_dim(spark, folder).join(vectors, "icd10_code")


def label_questions(spark, folder):
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    vectors = table(spark, folder, "embeddings").select("label", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    means = vectors.groupBy("label").agg(Summarizer.mean(F.col("v")).alias("m"))
    return means.select(
        "label", vector_to_array("m").alias("question_vector"), F.format_string("What marks group %d?", "label").alias("question_text")
    )


_TOP = """
    mean AS (SELECT label, list(m ORDER BY pos) AS q FROM (
        SELECT label, pos, avg(x) AS m FROM (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
        GROUP BY label, pos) GROUP BY label),
    idx AS (SELECT d.*, embedding::DOUBLE[] AS e FROM diagnosis_dim d JOIN embeddings ON icd10_code = CAST(vec_id AS VARCHAR) WHERE {where}),
    top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, icd10_code) AS rank
            FROM (SELECT label, icd10_code, round(list_cosine_similarity(e, q), 9) AS score FROM idx, mean)) WHERE rank <= {k})"""


def nearest(spark, folder, where=None, k=5):
    index = diagnosis_index(spark, folder)
    if where is not None:
        index = index.filter(where)
    return search.similarity_topk(index, "icd10_code", "embedding", label_questions(spark, folder), "label", "question_vector", k)


def in_units(hits):
    """Scores in billionths, the digits by which hits are ranked."""
    return hits.withColumn("score_e9", F.round(F.col("score") * 1e9).cast("bigint")).drop("score")


def rounded(hits):
    return hits.withColumn("score", F.round("score", 6))


@query("vector_topk", "diagnosis_dim", f"""WITH {_TOP.format(where="true", k=5)}
    SELECT label, icd10_code, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM top""")
def vector_topk(spark, folder):
    return rounded(nearest(spark, folder))


@query("vector_topk_filtered", "diagnosis_dim", f"""WITH {_TOP.format(where="category = 'ECONOMY' AND chronic_flag", k=3)}
    SELECT label, icd10_code, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM top""")
def vector_topk_filtered(spark, folder):
    return rounded(nearest(spark, folder, (F.col("category") == "ECONOMY") & F.col("chronic_flag"), 3))


_PROMPT = f"""WITH {_TOP.format(where="true", k=5)},
    stat AS (SELECT diagnosis_code, CAST(sum(claim_count) AS BIGINT) AS n FROM diagnosis_trends GROUP BY ALL),
    asked AS (SELECT label FROM mean UNION ALL SELECT -1),
    prompts AS (SELECT asked.label, CAST(count(t.icd10_code) AS INTEGER) AS context_docs,
           'Answer the question from the context. Say so if the context does not suffice.' || chr(10) || 'CONTEXT:' || chr(10)
           || coalesce(string_agg('- [' || t.icd10_code || '] ' || description || ': ' || coalesce(ai_description, 'N/A'), chr(10) ORDER BY rank), '')
           || chr(10) || 'CLAIMS:' || chr(10)
           || coalesce(string_agg(t.icd10_code || ': ' || n || ' claims', chr(10) ORDER BY rank), '')
           || chr(10) || 'QUESTION: What marks group ' || asked.label || '?' AS prompt
    FROM asked LEFT JOIN top t ON t.label = asked.label LEFT JOIN diagnosis_dim d ON t.icd10_code = d.icd10_code
    LEFT JOIN stat ON diagnosis_code = t.icd10_code GROUP BY asked.label)"""


@query("rag_context", "diagnosis_dim diagnosis_trends", _PROMPT + "SELECT * FROM prompts")
def rag_context(spark, folder):
    """One question has no vector, and so a prompt without context. Claims are
    counted for the codes that were found, and for no others."""
    nowhere = F.lit(None).cast("array<double>")
    questions = label_questions(spark, folder)
    questions = questions.unionByName(
        spark.range(1).select(
            F.lit(-1).alias("label"), nowhere.alias("question_vector"), F.lit("What marks group -1?").alias("question_text")
        )
    )
    hits = stored_copy(
        search.similarity_topk(diagnosis_index(spark, folder), "icd10_code", "embedding", questions, "label", "question_vector"), "hits"
    )
    dim = model.diagnosis_dim(spark, folder)
    found = hits.select(F.col("icd10_code").alias("diagnosis_code")).distinct()
    stats = (
        model.claims_fact(spark, folder).join(found, "diagnosis_code", "left_semi")
        .groupBy(F.col("diagnosis_code").alias("icd10_code")).agg(F.count("claim_id").alias("total_claims"))
    )
    label = F.concat(
        F.lit("["), F.col("icd10_code"), F.lit("] "), F.col("description"), F.lit(": "), F.coalesce("ai_description", F.lit("N/A"))
    )
    return search.context_prompts(
        hits, dim, "icd10_code", label, questions, "label", "question_text",
        stats, F.concat(F.col("icd10_code"), F.lit(": "), F.col("total_claims").cast("string"), F.lit(" claims")),
    )


@query("rag_answers", "diagnosis_dim diagnosis_trends",
       _PROMPT + "SELECT label, context_docs, 'Answer to: ' || prompt AS answer FROM prompts")
def rag_answers(spark, folder):
    """The model asked on each prompt. Answers are stored, so that it is asked once."""
    asked = enrich.ask_model(rag_context(spark, folder), F.col("prompt"), enrich.offline_text, "answer")
    return stored_copy(asked, "answers").drop("prompt")


@query("vector_topk_many", "diagnosis_dim", """
    WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
    q AS (SELECT vec_id * 8 + s AS q, CASE WHEN vec_id = 7 THEN NULL
                 ELSE list_transform(e, lambda x, i: CASE WHEN i % 7 = s THEN -x ELSE x END) END AS e
          FROM v, (SELECT unnest(range(5)) AS s)),
    idx AS (SELECT icd10_code, e FROM diagnosis_dim JOIN v ON icd10_code = CAST(vec_id AS VARCHAR))
    SELECT q, icd10_code, CAST(round(score * 1e9) AS BIGINT) AS score_e9, CAST(rank AS INTEGER) AS rank
    FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, icd10_code) AS rank
          FROM (SELECT q, icd10_code, round(list_cosine_similarity(idx.e, q.e), 9) AS score FROM q, idx WHERE q.e IS NOT NULL))
    WHERE rank <= 2""")
def vector_topk_many(spark, folder):
    """Five questions from each vector, asked of the whole index; one vector is NULL."""
    questions = turned_vectors(spark, folder)
    return in_units(search.similarity_topk(diagnosis_index(spark, folder), "icd10_code", "embedding", questions, "q", "qv", 2))


def turned_vectors(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("e"))
    return vectors.select("vec_id", "e", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("s")).select(
        (F.col("vec_id") * 8 + F.col("s")).alias("q"),
        F.when(F.col("vec_id") != 7, F.transform("e", lambda x, i: F.when((i + 1) % 7 == F.col("s"), -x).otherwise(x))).alias("qv"),
    )


@query("vector_topk_pruned", "", """
    WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
    q AS (SELECT vec_id * 8 + s AS q, CASE WHEN vec_id = 7 THEN NULL
                 ELSE list_transform(e, lambda x, i: CASE WHEN i % 7 = s THEN -x ELSE x END) END AS e
          FROM v, (SELECT unnest(range(5)) AS s))
    SELECT q, vec_id, CAST(round(score * 1e9) AS BIGINT) AS score_e9, CAST(rank AS INTEGER) AS rank, true AS within_all
    FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS rank
          FROM (SELECT q, vec_id, round(list_cosine_similarity(v.e, q.e), 9) AS score FROM q, v WHERE q.e IS NOT NULL))
    WHERE rank <= 3""")
def vector_topk_pruned(spark, folder):
    """The same questions asked of all vectors through the inverted file: all
    answers, from no more comparisons than there are vectors."""
    vectors = table(spark, folder, "embeddings")
    built = InvertedFile.build(vectors, "vec_id", "embedding")
    hits = built.search(turned_vectors(spark, folder), "q", "qv", 3)
    return in_units(hits.withColumn("within_all", F.col("scored") <= int(built.n.sum())).drop("scored"))


@query("index_coverage", "diagnosis_dim", """
    SELECT count(*) AS codes, count(vec_id) AS with_vector, count(*) - count(vec_id) AS without_vector,
           count(*) FILTER (vec_id IS NULL AND ai_description IS NOT NULL) AS described_without_vector
    FROM diagnosis_dim LEFT JOIN embeddings ON icd10_code = CAST(vec_id AS VARCHAR)""")
def index_coverage(spark, folder):
    """How many codes the searches by stored vectors can find, and how many
    have no vector yet and so are never found by them."""
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").cast("string").alias("icd10_code"), F.lit(1).alias("v"))
    return search.vector_coverage(model.diagnosis_dim(spark, folder).join(vectors, "icd10_code", "left"), "v", "ai_description")


@query("index_ready", "diagnosis_dim", """
    SELECT count(ai_description) AS enriched, count(ai_description) >= 10 AS ready FROM diagnosis_dim""")
def index_ready(spark, folder):
    return search.ready_to_index(model.diagnosis_dim(spark, folder))


@query("index_sync", "", """
    SELECT doc_id, 'insert' AS action, md5(text) AS text_hash, length(text) AS chars FROM documents WHERE doc_id % 10 = 0
    UNION ALL SELECT doc_id, 'update', md5(text), length(text) FROM documents WHERE doc_id % 10 = 1
    UNION ALL SELECT -1 - doc_id, 'delete', NULL, NULL FROM documents WHERE doc_id % 10 = 2""")
def index_sync(spark, folder):
    """The index at hand lacks some documents, has old text of others and
    still holds a few that are gone."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    group = F.col("doc_id") % 10
    known = docs.filter(group != 0).select(
        "doc_id", F.md5(F.when(group == 1, F.concat("text", F.lit(" old"))).otherwise(F.col("text"))).alias("text_hash")
    )
    gone = docs.filter(group == 2).select((-1 - F.col("doc_id")).alias("doc_id"), F.md5("text").alias("text_hash"))
    plan = search.sync_plan(known.unionByName(gone), docs, "doc_id", "text")
    return plan.select("doc_id", "action", "text_hash", F.length("text").cast("bigint").alias("chars"))


_VECTORS = r"""
    words AS (SELECT 'd' AS side, doc_id AS id, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS w FROM documents
              UNION ALL SELECT 'q', item_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) FROM benchmark),
    counts AS (SELECT side, id, CAST(CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 256 AS INTEGER) AS dim, count(*) AS tf
               FROM words WHERE w <> '' GROUP BY ALL),
    idf AS (SELECT dim, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) AS idf FROM counts WHERE side = 'd' GROUP BY dim),
    weighed AS (SELECT side, id, dim, tf * idf AS x FROM counts JOIN idf USING (dim)),
    norm AS (SELECT side, id, sqrt(sum(x * x)) AS n FROM weighed GROUP BY ALL),
    dots AS (SELECT q.id AS item_id, d.id AS doc_id, sum(q.x * d.x) AS dot FROM weighed q JOIN weighed d ON q.dim = d.dim
             WHERE q.side = 'q' AND d.side = 'd' GROUP BY ALL),
    scores AS (SELECT item_id, doc_id, round(dot / q.n / d.n, 9) AS score FROM dots
               JOIN norm q ON q.side = 'q' AND q.id = item_id JOIN norm d ON d.side = 'd' AND d.id = doc_id)"""


@query("text_search", "", f"""WITH {_VECTORS}
    SELECT item_id, doc_id, CAST(round(score * 1e9) AS BIGINT) AS score_e9, CAST(rank AS INTEGER) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores) WHERE rank <= 5""")
def text_search(spark, folder):
    """Benchmark passages looked up in the documents by TF-IDF vectors."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    counts = stored_copy(search.term_counts(docs, "doc_id", "text"), "terms")
    weights = stored_copy(search.dimension_weights(counts, docs), "weights")
    asked = search.term_counts(table(spark, folder, "benchmark"), "item_id", "text")
    # stored, as the search counts both sides before it compares them
    questions = stored_copy(search.hashed_vectors(asked, weights, "item_id"), "question-vectors")
    vectors = stored_copy(search.hashed_vectors(counts, weights, "doc_id"), "document-vectors")
    return in_units(search.similarity_topk(vectors, "doc_id", "embedding", questions, "item_id", "embedding", 5))


@query("index_synced", "", """
    SELECT doc_id, md5(text) AS text_hash, length(text) AS vec FROM documents WHERE text IS NOT NULL""")
def index_synced(spark, folder):
    """The index after the sync of ``index_sync``; the vector here is the text's length."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    group = F.col("doc_id") % 10
    known = docs.filter(group != 0).select(
        "doc_id", F.md5(F.when(group == 1, F.concat("text", F.lit(" old"))).otherwise(F.col("text"))).alias("text_hash"),
        F.length("text").cast("bigint").alias("vec"),
    )
    gone = docs.filter(group == 2).select((-1 - F.col("doc_id")).alias("doc_id"), F.md5("text").alias("text_hash"), F.lit(0).cast("bigint").alias("vec"))
    index = known.unionByName(gone)
    plan = search.sync_plan(index, docs, "doc_id", "text")
    return search.apply_sync(index, plan.withColumn("vec", F.length("text").cast("bigint")), "doc_id")
