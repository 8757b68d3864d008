"""Catalogue queries: answers, submissions, permissions, publication, search."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.functions.sheet_cells import parse_dependency
from strataflow.functions.text import html_escape
from strataflow.functions.typed_values import EMAIL, URL, join_choices, split_choices
from strataflow.operators import access, answers, search, sketches, submissions
from strataflow.plans.publication import publish
from strataflow.operators.answerstore import AnswerStore
from strataflow.operators.answerindex import index_answers, search_indexed
from strataflow.plans.searching import maintain_index, run_indexed_searches, run_searches
from strataflow.session import cut_lineage, stage_dir
from workload.base import VIEWS, query, with_views

QUESTIONS = [
    (1, 1, 1, "language", "Language", "single choice", True, True, "required: true"),
    (1, 1, 2, "source", "Data source", "short text", True, True, 'required: true min_length: 5 regex:"^src1"'),
    (1, 1, 3, "size", "Number of records", "integer", True, True, "min_value: 100 max_value:20000"),
    (1, 2, 1, "description", "Description", "long text", False, True, "max_length : 8000"),
    (1, 2, 2, "quality", "Quality checked", "integer", True, False, "required:true max_value: 0.5"),
    (1, 2, 3, "toxic", "Contains toxic parts", "single choice", False, False, ""),
    (2, 1, 1, "opened_on", "Opened on", "date", True, True, "min_date: 1995-06-01 max_date: 2000-12-31 format: yyyy-MM-dd"),
    (2, 1, 2, "amount", "Amount", "numeric", True, True, "min_value: 10000.5 max_value: 450000"),
    (2, 1, 3, "contact", "Contact", "email", False, True, ""),
    (2, 1, 4, "status", "Status", "single choice", False, True, ""),
    (3, 1, 1, "homepage", "Homepage", "url", False, True, ""),
    # A slug of the first questionnaire, of another type and with other constraints.
    (3, 1, 2, "source", "Path of the page", "url", True, True, "required: true"),
]
QUESTION_SCHEMA = (
    "questionnaire int, question_set int, number int, question string, text string, type string, "
    "required boolean, searchable boolean, constraints string"
)
CHOICES = [(1, "language", i + 1, v, 100 + i) for i, v in enumerate(["en", "de", "fr", "es"])] + [
    (1, "quality", 1, "0", 201),
    (1, "quality", 2, "1", 202),
]
LOOKS = [(4, "look", w, 300 + i) for i, w in enumerate(
    ["small", "large", "red", "blue", "hot", "cold", "ring", "bolt", "gear", "plate", "rod"]
)]
DEPENDENCIES = [(1, "quality", "language|1"), (1, "toxic", "quality|2"), (1, "description", "language|de")]
COMMUNITIES = [("en", "open", True), ("de", "public", False), ("fr", "moderated", True), ("es", "invitation", False)]
VIEWER = 7
LANGUAGES = ["de", "en", "es", "fr"]


def _rows(values) -> str:
    return ", ".join(str(v).replace("True", "TRUE").replace("False", "FALSE") for v in values)


VIEWS["questions"] = (
    "SELECT * FROM (VALUES "
    + ", ".join(
        "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v).upper() for v in q) + ")" for q in QUESTIONS
    )
    + ") AS q(questionnaire, question_set, number, question, text, type, required, searchable, constraints)"
)

# Documents answer the first questionnaire, pages the third; their numbers are kept apart.
PAGE = 1_000_000_000_000

VIEWS["fingerprints"] = f"""
SELECT doc_id AS fingerprint, 1 AS questionnaire, lang AS community, doc_id % 50 AS owner, n_chars < 1000 AS draft
FROM documents
UNION ALL SELECT page_id + {PAGE}, 3, ({LANGUAGES})[page_id % 4 + 1], page_id % 50, page_id % 3 <> 0 FROM pages"""

# Every tenth page has answers to a questionnaire that is not its own, every third none to a required question.
VIEWS["answers"] = f"""
SELECT doc_id AS fingerprint, 1 AS questionnaire, 'language' AS question, lang AS value FROM documents
UNION ALL SELECT doc_id, 1, 'source', source FROM documents
UNION ALL SELECT doc_id, 1, 'size', CAST(n_chars AS VARCHAR) FROM documents
UNION ALL SELECT doc_id, 1, 'description', text FROM documents
UNION ALL SELECT doc_id, 1, 'quality', CAST(quality AS VARCHAR) FROM labels
UNION ALL SELECT doc_id, 1, 'toxic', CASE WHEN toxic = 1 THEN 'yes' ELSE ' ' END FROM labels
UNION ALL SELECT page_id + {PAGE}, 3, 'homepage', url FROM pages
UNION ALL SELECT page_id + {PAGE}, 3, 'source', CASE WHEN page_id % 3 = 1 THEN ' ' ELSE url END FROM pages
UNION ALL SELECT page_id + {PAGE}, 1, 'source', 'stray' FROM pages WHERE page_id % 10 = 0"""

# A second questionnaire answered by every order.
VIEWS["form_answers"] = """
SELECT o_orderkey AS fingerprint, 2 AS questionnaire, 'opened_on' AS question,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS value FROM orders
UNION ALL SELECT o_orderkey, 2, 'amount', CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) FROM orders
UNION ALL SELECT o_orderkey, 2, 'contact', 'user' || o_custkey ||
       CASE WHEN o_orderpriority = '1-URGENT' THEN '@mail' ELSE '@mail.example.org' END FROM orders
UNION ALL SELECT o_orderkey, 2, 'status', o_orderstatus FROM orders"""

VIEWS["stored_permissions"] = """
SELECT doc_id AS fingerprint, 2 AS question_set, quality = 1 AS visible, toxic = 0 AS indexable,
       CASE WHEN quality = 0 THEN FALSE END AS exportable FROM labels WHERE quality = 0 OR toxic = 1"""

VIEWS["memberships"] = f"""
SELECT user_id, ({LANGUAGES})[CAST(json_extract(props, '$.k') AS BIGINT) % 4 + 1] AS community,
       CASE WHEN count(*) > 20 THEN 'manager' ELSE 'member' END AS role,
       bool_or(event_type = 'click') AS accepted, count(*) FILTER (WHERE event_type = 'signup') > 2 AS approved
FROM events GROUP BY ALL"""

VIEWS["saves"] = """
SELECT conv_id AS fingerprint, turn AS seq, role AS question,
       CASE WHEN length(text) % 4 = 0 THEN ' ' ELSE text END AS value,
       CASE WHEN length(text) % 11 <> 0 THEN 'token-' || (turn // 3) END AS token FROM conversations"""

VIEWS["submitted"] = """
SELECT fingerprint, seq, question, value, token,
       (sum(opens) OVER (PARTITION BY fingerprint ORDER BY seq))::BIGINT AS submission
FROM (SELECT *, CASE WHEN token IS NULL OR token IS DISTINCT FROM lag(token) OVER (PARTITION BY fingerprint ORDER BY seq)
             THEN 1 ELSE 0 END AS opens FROM saves)"""

VIEWS["writes"] = """
SELECT fingerprint, submission, question, seq, CASE WHEN trim(value) <> '' THEN value END AS value FROM submitted
QUALIFY row_number() OVER (PARTITION BY fingerprint, submission, question ORDER BY seq DESC) = 1"""

VIEWS["changes"] = """
SELECT fingerprint, submission, question, previous, value AS next FROM (
  SELECT *, lag(value) OVER (PARTITION BY fingerprint, question ORDER BY submission) AS previous FROM writes)
WHERE previous IS DISTINCT FROM value"""


def questions(t) -> DataFrame:
    return t.values(QUESTIONS, QUESTION_SCHEMA)


def fingerprints(t) -> DataFrame:
    documents = t.read("documents").select(
        F.col("doc_id").alias("fingerprint"),
        F.lit(1).alias("questionnaire"),
        F.col("lang").alias("community"),
        (F.col("doc_id") % 50).alias("owner"),
        (F.col("n_chars") < 1000).alias("draft"),
    )
    page = F.col("page_id")
    pages = t.read("pages").select(
        (page + PAGE).alias("fingerprint"),
        F.lit(3).alias("questionnaire"),
        F.get(F.array(*[F.lit(c) for c in LANGUAGES]), (page % 4).cast("int")).alias("community"),
        (page % 50).alias("owner"),
        (page % 3 != 0).alias("draft"),
    )
    return documents.unionByName(pages)


def document_answers(t) -> DataFrame:
    own, other = F.lit(1), F.lit(3)
    written = answers.unpivot_answers(
        t.read("documents"),
        "doc_id",
        own,
        {
            "language": F.col("lang"),
            "source": F.col("source"),
            "size": F.col("n_chars"),
            "description": F.col("text"),
        },
    )
    judged = answers.unpivot_answers(
        t.read("labels"),
        "doc_id",
        own,
        {"quality": F.col("quality"), "toxic": F.when(F.col("toxic") == 1, "yes").otherwise(" ")},
    )
    pages = t.read("pages").withColumn("fingerprint", F.col("page_id") + PAGE)
    path = F.when(F.col("page_id") % 3 == 1, " ").otherwise(F.col("url"))
    paged = answers.unpivot_answers(pages, "fingerprint", other, {"homepage": F.col("url"), "source": path})
    stray = answers.unpivot_answers(pages.where(F.col("page_id") % 10 == 0), "fingerprint", own, {"source": F.lit("stray")})
    return written.unionByName(judged).unionByName(paged).unionByName(stray)


def form_answers(t) -> DataFrame:
    priority = F.col("o_orderpriority")
    host = F.when(priority == "1-URGENT", "@mail").otherwise("@mail.example.org")
    return answers.unpivot_answers(
        t.read("orders"),
        "o_orderkey",
        F.lit(2),
        {
            "opened_on": F.when(priority == "5-LOW", "soon").otherwise(F.col("o_orderdate").cast("date").cast("string")),
            "amount": F.col("o_totalprice").cast("decimal(18,2)"),
            "contact": F.concat(F.lit("user"), F.col("o_custkey").cast("string"), host),
            "status": F.col("o_orderstatus"),
        },
    )


def stored_permissions(t) -> DataFrame:
    good, toxic = F.col("quality") == 1, F.col("toxic") == 1
    return t.read("labels").where(~good | toxic).select(
        F.col("doc_id").alias("fingerprint"),
        F.lit(2).alias("question_set"),
        good.alias("visible"),
        (~toxic).alias("indexable"),
        F.when(~good, F.lit(False)).alias("exportable"),
    )


def memberships(t) -> DataFrame:
    key = (F.get_json_object("props", "$.k").cast("int") % 4).cast("int")
    language = F.get(F.array(*[F.lit(c) for c in LANGUAGES]), key)
    return t.read("events").groupBy("user_id", language.alias("community")).agg(
        F.when(F.count(F.lit(1)) > 20, "manager").otherwise("member").alias("role"),
        F.bool_or(F.col("event_type") == "click").alias("accepted"),
        (F.count_if(F.col("event_type") == "signup") > 2).alias("approved"),
    )


def saves(t) -> DataFrame:
    size = F.length("text")
    return t.read("conversations").select(
        F.col("conv_id").alias("fingerprint"),
        F.col("turn").alias("seq"),
        F.col("role").alias("question"),
        F.when(size % 4 == 0, " ").otherwise(F.col("text")).alias("value"),
        F.when(size % 11 != 0, F.concat(F.lit("token-"), F.floor(F.col("turn") / 3).cast("string"))).alias("token"),
    )


def writes(t) -> DataFrame:
    return submissions.last_writes(submissions.open_submissions(saves(t)))


@query(
    "typed_answers",
    with_views("answers", "form_answers", "questions")
    + """, everything AS (SELECT * FROM answers UNION ALL SELECT * FROM form_answers)
SELECT a.fingerprint, a.questionnaire, a.question,
       CASE q.type WHEN 'single choice' THEN 'choice' WHEN 'integer' THEN 'integer' WHEN 'numeric' THEN 'numeric'
            WHEN 'date' THEN 'date' ELSE 'text' END AS answer_kind,
       CASE WHEN q.type IN ('short text', 'long text', 'email', 'url') THEN value END AS text_value,
       CASE WHEN q.type = 'integer' THEN TRY_CAST(value AS BIGINT) END AS integer_value,
       CASE WHEN q.type = 'numeric' THEN TRY_CAST(value AS DOUBLE) END AS numeric_value,
       CASE WHEN q.type = 'date' THEN TRY_CAST(value AS DATE) END AS date_value,
       CASE WHEN q.type = 'single choice' THEN value END AS choice_value
FROM everything a JOIN questions q ON a.questionnaire = q.questionnaire AND a.question = q.question""",
)
def _typed_answers(t):
    typed = answers.type_answers(document_answers(t).unionByName(form_answers(t)), questions(t))
    return typed.select(
        "fingerprint", "questionnaire", "question", "answer_kind", "text_value", "integer_value", "numeric_value", "date_value",
        "choice_value",
    )


@query(
    "answer_errors",
    with_views("fingerprints", "answers", "form_answers")
    + f""", own AS (SELECT fingerprint, question, value FROM answers WHERE questionnaire = 1 AND trim(value) <> ''),
paged AS (SELECT fingerprint, question, value FROM answers WHERE questionnaire = 3 AND trim(value) <> ''),
required(questionnaire, question) AS (VALUES (1, 'language'), (1, 'source'), (1, 'quality'), (3, 'source'))
SELECT fingerprint, 1 AS questionnaire, question, 'min_length' AS code FROM own WHERE question = 'source' AND length(value) < 5
UNION ALL SELECT fingerprint, 1, question, 'regex' FROM own WHERE question = 'source' AND NOT regexp_matches(value, '^src1')
UNION ALL SELECT fingerprint, 1, question, 'min_value' FROM own WHERE question = 'size' AND TRY_CAST(value AS DOUBLE) < 100
UNION ALL SELECT fingerprint, 1, question, 'max_value' FROM own WHERE question = 'size' AND TRY_CAST(value AS DOUBLE) > 20000
UNION ALL SELECT fingerprint, 1, question, 'max_length' FROM own WHERE question = 'description' AND length(value) > 8000
UNION ALL SELECT fingerprint, 1, question, 'max_value' FROM own WHERE question = 'quality' AND TRY_CAST(value AS DOUBLE) > 0.5
UNION ALL SELECT f.fingerprint, f.questionnaire, r.question, 'required' FROM fingerprints f
  JOIN required r ON f.questionnaire = r.questionnaire WHERE NOT EXISTS (SELECT 1 FROM answers a
    WHERE a.fingerprint = f.fingerprint AND a.questionnaire = r.questionnaire AND a.question = r.question AND trim(a.value) <> '')
UNION ALL SELECT fingerprint, 2, question, 'format' FROM form_answers
  WHERE question = 'opened_on' AND TRY_CAST(value AS DATE) IS NULL
UNION ALL SELECT fingerprint, 2, question, 'min_date' FROM form_answers
  WHERE question = 'opened_on' AND TRY_CAST(value AS DATE) < DATE '1995-06-01'
UNION ALL SELECT fingerprint, 2, question, 'max_date' FROM form_answers
  WHERE question = 'opened_on' AND TRY_CAST(value AS DATE) > DATE '2000-12-31'
UNION ALL SELECT fingerprint, 2, question, 'min_value' FROM form_answers
  WHERE question = 'amount' AND CAST(CASE WHEN question = 'amount' THEN value END AS DOUBLE) < 10000.5
UNION ALL SELECT fingerprint, 2, question, 'max_value' FROM form_answers
  WHERE question = 'amount' AND CAST(CASE WHEN question = 'amount' THEN value END AS DOUBLE) > 450000
UNION ALL SELECT fingerprint, 2, question, 'email' FROM form_answers
  WHERE question = 'contact' AND NOT regexp_matches(value, '{EMAIL}')
UNION ALL SELECT fingerprint, 3, question, 'url' FROM paged WHERE NOT regexp_matches(value, '{URL}')""",
)
def _answer_errors(t):
    given = document_answers(t)
    failed = answers.answer_errors(given.unionByName(form_answers(t)), questions(t))
    missing = answers.missing_answers(fingerprints(t), questions(t), given)
    return failed.unionByName(missing)


@query(
    "choice_resolution",
    f"""WITH choices(questionnaire, question, ident, choice_key) AS (VALUES {_rows(LOOKS)}),
chosen AS (SELECT p_partkey AS fingerprint, 'look' AS question, unnest(string_split(p_name, ' ')) AS ident FROM part)
SELECT c.question, c.ident, c.fingerprint, k.choice_key::INT AS choice_key, k.choice_key IS NOT NULL AS known
FROM chosen c LEFT JOIN choices k ON c.question = k.question AND c.ident = k.ident""",
)
def _choice_resolution(t):
    given = t.read("part").select(
        F.col("p_partkey").alias("fingerprint"),
        F.lit(4).alias("questionnaire"),
        F.lit("look").alias("question"),
        F.replace("p_name", F.lit(" "), F.lit(", ")).alias("value"),
    )
    looks = t.values(LOOKS, "questionnaire int, question string, ident string, choice_key int")
    return answers.resolve_choices(given, looks).drop("questionnaire")


@query(
    "choice_rejects",
    f"""WITH choices(questionnaire, question, ident, choice_key) AS (VALUES {_rows(LOOKS)}),
chosen AS (SELECT p_partkey AS fingerprint, 'look' AS question, unnest(string_split(p_name, ' ')) AS ident FROM part)
SELECT question, ident, fingerprint FROM chosen WHERE ident NOT IN (SELECT ident FROM choices)""",
)
def _choice_rejects(t):
    given = t.read("part").select(
        F.col("p_partkey").alias("fingerprint"),
        F.lit(4).alias("questionnaire"),
        F.lit("look").alias("question"),
        F.replace("p_name", F.lit(" "), F.lit(", ")).alias("value"),
    )
    looks = t.values(LOOKS, "questionnaire int, question string, ident string, choice_key int")
    return answers.unknown_choices(given, looks).drop("questionnaire")


@query(
    "choices_joined",
    "SELECT p_partkey AS fingerprint, replace(p_name, ' ', ';') AS stored, "
    "len(string_split(p_name, ' '))::INT AS chosen FROM part",
)
def _choices_joined(t):
    chosen = split_choices(F.col("p_name"), " ")
    return t.read("part").select(
        F.col("p_partkey").alias("fingerprint"), join_choices(chosen, ";").alias("stored"), F.size(chosen).alias("chosen")
    )


@query(
    "dependency_surplus",
    with_views("answers")
    + """, needs(question, requires_question, requires_choice) AS (VALUES
  ('quality', 'language', 'en'), ('toxic', 'quality', '1'), ('description', 'language', 'de'))
SELECT a.fingerprint, a.questionnaire, a.question, n.requires_question, n.requires_choice,
       NOT EXISTS (SELECT 1 FROM answers s WHERE s.fingerprint = a.fingerprint AND s.questionnaire = 1
                   AND s.question = n.requires_question AND s.value = n.requires_choice) AS surplus
FROM answers a JOIN needs n ON a.questionnaire = 1 AND a.question = n.question""",
)
def _dependency_surplus(t):
    choices = t.values(CHOICES, "questionnaire int, requires_question string, place int, ident string, choice_key int")
    parsed = t.values(DEPENDENCIES, "questionnaire int, question string, dependencies string").select(
        "questionnaire", "question", parse_dependency(F.col("dependencies")).alias("d")
    )
    needs = parsed.select(
        "questionnaire",
        "question",
        F.col("d.slug").alias("requires_question"),
        F.col("d.choice_index").alias("place"),
        "d.choice_ident",
    ).join(choices, ["questionnaire", "requires_question", "place"], "left")
    chosen = F.coalesce("ident", "choice_ident").alias("requires_choice")
    needs = needs.select("questionnaire", "question", "requires_question", chosen)
    given = document_answers(t)
    selected = given.where(F.col("question").isin("language", "quality")).withColumnRenamed("value", "choice")
    return answers.surplus_answers(given.select("fingerprint", "questionnaire", "question"), needs, selected)


VIEWS["filled"] = """
SELECT f.fingerprint, q.question_set, count(CASE WHEN trim(a.value) <> '' THEN 1 END) AS answered, count(*) AS questions
FROM fingerprints f JOIN questions q ON f.questionnaire = q.questionnaire
LEFT JOIN answers a ON a.fingerprint = f.fingerprint AND a.questionnaire = q.questionnaire AND a.question = q.question
GROUP BY f.fingerprint, q.question_set"""


@query(
    "fill_percentage",
    with_views("filled")
    + "SELECT *, round(100 * answered / questions, 2) AS percentage FROM filled",
)
def _fill_percentage(t):
    return answers.fill_percentage(fingerprints(t), questions(t), document_answers(t))


VIEWS["publication"] = """
SELECT f.fingerprint, f.community, f.draft,
       count(*) FILTER (WHERE regexp_matches(q.constraints, 'required *: *true') AND coalesce(trim(a.value), '') = '')
       AS missing_required
FROM fingerprints f JOIN questions q ON f.questionnaire = q.questionnaire
LEFT JOIN answers a ON a.fingerprint = f.fingerprint AND a.questionnaire = q.questionnaire AND a.question = q.question
GROUP BY f.fingerprint, f.community, f.draft"""


@query(
    "publish_gate",
    with_views("publication") + "SELECT fingerprint, missing_required, missing_required = 0 AS complete FROM publication",
)
def _publish_gate(t):
    checked = answers.publishable(fingerprints(t), questions(t), document_answers(t))
    return checked.select("fingerprint", "missing_required", "complete")


@query(
    "publish_outcome",
    with_views("publication")
    + f""", settings(community, access, auto_accept) AS (VALUES {_rows(COMMUNITIES)})
SELECT p.fingerprint, CASE WHEN NOT draft THEN 'published' WHEN missing_required > 0 THEN 'draft'
       WHEN auto_accept THEN 'published' ELSE 'pending' END AS state
FROM publication p JOIN settings s ON p.community = s.community""",
)
def _publish_outcome(t):
    communities = t.values(COMMUNITIES, "community string, access string, auto_accept boolean")
    outcome = publish(fingerprints(t), communities, questions(t), document_answers(t))
    return outcome.select("fingerprint", "state")


@query(
    "summary_rows",
    with_views("fingerprints", "questions", "answers")
    + """SELECT f.fingerprint, q.question_set, q.number, q.text AS name, a.value
FROM fingerprints f JOIN questions q ON f.questionnaire = q.questionnaire
LEFT JOIN answers a ON a.fingerprint = f.fingerprint AND a.questionnaire = q.questionnaire AND a.question = q.question""",
)
def _summary_rows(t):
    return answers.summary_rows(fingerprints(t), questions(t), document_answers(t))


@query(
    "summary_wide",
    """SELECT d.doc_id AS fingerprint, d.lang AS language, d.source, CAST(n_chars AS VARCHAR) AS size,
       CAST(l.quality AS VARCHAR) AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def _summary_wide(t):
    slugs = ["language", "source", "size", "quality"]
    own = document_answers(t).where((F.col("questionnaire") == 1) & F.col("question").isin(slugs))
    return answers.summary_wide(own.join(t.read("documents"), F.col("fingerprint") == F.col("doc_id"), "left_semi"), slugs)


@query("submission_sessions", with_views("submitted") + "SELECT fingerprint, seq, question, submission FROM submitted")
def _sessions(t):
    return submissions.open_submissions(saves(t)).select("fingerprint", "seq", "question", "submission")


@query(
    "submission_current",
    with_views("writes")
    + """SELECT fingerprint, question, submission, value FROM (SELECT * FROM writes
  QUALIFY row_number() OVER (PARTITION BY fingerprint, question ORDER BY submission DESC) = 1) WHERE value IS NOT NULL""",
)
def _current(t):
    return submissions.current_answers(writes(t))


@query("answer_changes", with_views("changes") + "SELECT * FROM changes")
def _changes(t):
    return submissions.answer_changes(cut_lineage(writes(t)))


@query(
    "answer_upsert",
    """SELECT d.doc_id AS fingerprint, 'language' AS question,
       CASE WHEN l.doc_id IS NULL THEN lang ELSE 'reviewed' END AS value
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL OR quality = 1
UNION ALL SELECT doc_id, 'source', source FROM documents""",
)
def _upsert(t):
    given = answers.unpivot_answers(
        t.read("documents"), "doc_id", F.lit(1), {"language": F.col("lang"), "source": F.col("source")}
    )
    changed = answers.unpivot_answers(
        t.read("labels"), "doc_id", F.lit(1), {"language": F.when(F.col("quality") == 1, "reviewed").otherwise("")}
    )
    return submissions.upsert_answers(given, changed)


# Three changes of one question, in an order that their values don't have; every third document's last one is empty.
PUTS = """SELECT d.doc_id AS fingerprint, 'language' AS question,
       CASE WHEN l.doc_id IS NULL THEN lang WHEN l.doc_id % 2 = 0 THEN 'b second' ELSE 'a third' END AS value
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL OR l.doc_id % 3 <> 0
UNION ALL SELECT doc_id, 'source', source FROM documents"""


def _puts(t) -> DataFrame:
    even, empty = F.col("doc_id") % 2 == 0, F.col("doc_id") % 3 == 0
    changes = F.array(
        F.struct(F.lit(5).alias("seq"), F.lit("c first").alias("value")),
        F.struct(F.lit(7).alias("seq"), F.lit("b second").alias("value")),
        F.struct(F.when(even, 6).otherwise(8).alias("seq"), F.lit("a third").alias("value")),
        F.struct(F.when(empty, 9).otherwise(1).alias("seq"), F.lit(" ").alias("value")),
    )
    rows = t.read("labels").select(F.col("doc_id").alias("fingerprint"), F.lit("language").alias("question"), F.inline(changes))
    return rows.select("fingerprint", "question", "value", F.col("seq").cast("long").alias("seq"))


@query("answer_upsert_sequence", PUTS)
def _upsert_sequence(t):
    """Several changes of one question: the last by sequence counts."""
    given = answers.unpivot_answers(
        t.read("documents"), "doc_id", F.lit(1), {"language": F.col("lang"), "source": F.col("source")}
    )
    return submissions.upsert_answers(given, _puts(t))


@query("answer_store", PUTS)
def _answer_store(t):
    """The same from the store: a base, deltas that come out of order, one written twice, a merge in between."""
    store = AnswerStore(t.spark, f"{stage_dir(t.spark, 'jobs')}/store-{uuid.uuid4().hex}", 8)
    given = answers.unpivot_answers(
        t.read("documents"), "doc_id", F.lit(1), {"language": F.col("lang"), "source": F.col("source")}
    )
    store.put(given.select("fingerprint", "question", "value", F.lit(0).alias("sequence")), 0)
    store.merge()
    puts = _puts(t).withColumnRenamed("seq", "sequence")
    for batch_id, later in ((1, True), (1, True), (2, False)):
        store.put(puts.where((F.col("sequence") >= 7) == later), batch_id)
        if not later:
            store.merge()
    if store.merge():
        raise AssertionError("a merge without deltas wrote buckets")
    return store.current()


@query(
    "non_empty_answers",
    with_views("saves") + "SELECT fingerprint, seq, question, value FROM saves WHERE trim(value) <> ''",
)
def _non_empty(t):
    return answers.non_empty(saves(t)).select("fingerprint", "seq", "question", "value")


@query(
    "change_notifications",
    with_views("changes")
    + """, subscriptions AS (SELECT DISTINCT user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS fingerprint
   FROM events WHERE event_type = 'signup'),
changed AS (SELECT fingerprint, count(*) AS changes, max(submission) AS last_submission FROM changes GROUP BY fingerprint)
SELECT s.user_id, s.fingerprint, c.changes, c.last_submission
FROM subscriptions s JOIN changed c ON s.fingerprint = c.fingerprint""",
)
def _notifications(t):
    subscribed = t.read("events").where(F.col("event_type") == "signup").select(
        "user_id", F.get_json_object("props", "$.k").cast("long").alias("fingerprint")
    )
    return submissions.notifications(submissions.answer_changes(cut_lineage(writes(t))), subscribed)


@query(
    "permission_defaults",
    with_views("fingerprints", "stored_permissions")
    + """SELECT f.fingerprint, s.question_set, coalesce(p.visible, TRUE) AS visible,
       coalesce(p.indexable, TRUE) AS indexable, coalesce(p.exportable, TRUE) AS exportable
FROM fingerprints f CROSS JOIN (VALUES (1), (2)) AS s(question_set)
LEFT JOIN stored_permissions p ON p.fingerprint = f.fingerprint AND p.question_set = s.question_set""",
)
def _permission_defaults(t):
    sets = fingerprints(t).select("fingerprint", F.explode(F.array(F.lit(1), F.lit(2))).alias("question_set"))
    return access.with_permissions(sets, stored_permissions(t))


@query(
    "visible_fingerprints",
    with_views("fingerprints", "memberships")
    + f""", settings(community, access, auto_accept) AS (VALUES {_rows(COMMUNITIES)}),
mine AS (SELECT * FROM memberships WHERE user_id = {VIEWER})
SELECT f.fingerprint, f.community FROM fingerprints f JOIN settings s ON f.community = s.community
LEFT JOIN mine m ON m.community = f.community
WHERE f.owner = {VIEWER} OR coalesce(m.role = 'manager', FALSE) OR (NOT f.draft AND (s.access = 'open'
   OR (s.access = 'public' AND coalesce(m.accepted, FALSE))
   OR (s.access IN ('moderated', 'invitation') AND coalesce(m.approved, FALSE))))""",
)
def _visible(t):
    communities = t.values(COMMUNITIES, "community string, access string, auto_accept boolean")
    seen = access.visible_fingerprints(fingerprints(t), communities, memberships(t), VIEWER)
    return seen.select("fingerprint", "community")


SEARCHES = {
    1: search.All((search.Match("language", "equals", "EN"), search.Match("size", "at_least", 3000))),
    2: search.All(
        (
            search.Any((search.Match("source", "contains", "src1"), search.Match("description", "contains", "the "))),
            search.Not(search.Match("language", "equals", "de")),
        )
    ),
    3: search.Any((search.Match("size", "at_most", 500), search.Match("quality", "equals", "1"))),
}

VIEWS["search_hits"] = """
SELECT doc_id AS fingerprint, 1::INT AS search_id FROM documents WHERE lang = 'en' AND n_chars >= 3000
UNION ALL SELECT d.doc_id, 2 FROM documents d LEFT JOIN stored_permissions p ON d.doc_id = p.fingerprint
WHERE (contains(source, 'src1') OR (contains(lower(text), 'the ') AND coalesce(p.indexable, TRUE))) AND lang <> 'de'
UNION ALL SELECT doc_id, 3 FROM documents WHERE n_chars <= 500
UNION ALL SELECT page_id + 1000000000000, 2 FROM pages WHERE contains(lower(url), 'src1') AND page_id % 3 <> 1"""


def searches(t):
    return run_searches(fingerprints(t), document_answers(t), questions(t), stored_permissions(t), SEARCHES)


@query("search_boolean", with_views("stored_permissions", "search_hits") + "SELECT * FROM search_hits")
def _search(t):
    return searches(t).hits


@query("search_indexed", with_views("stored_permissions", "search_hits") + "SELECT * FROM search_hits")
def _search_indexed(t):
    """The same searches from an index over the answers."""
    path = f"{stage_dir(t.spark, 'jobs')}/index-{uuid.uuid4().hex}"
    maintain_index(document_answers(t), questions(t), stored_permissions(t), path, 0)
    return run_indexed_searches(t.spark, fingerprints(t), path, SEARCHES).hits


TEXT_SEARCHES = {
    1: search.Match("description", "contains", "changed to"),
    2: search.All((search.Match("description", "contains", "tion"), search.Not(search.Match("language", "equals", "en")))),
    3: search.Match("description", "contains", "é"),
    4: search.Any((search.Match("size", "at_least", 9000), search.Match("size", "at_most", 20))),
    5: search.All((search.Match("homepage", "contains", "/es/"), search.Match("homepage", "contains", "ht"))),
}


@query(
    "search_indexed_batches",
    """WITH texts AS (SELECT doc_id, lang, n_chars, CASE WHEN doc_id % 7 = 0 THEN 'Changed to ' || doc_id WHEN doc_id % 7 <> 1
       THEN lower(text) END AS text FROM documents)
SELECT doc_id AS fingerprint, 1::INT AS search_id FROM texts WHERE doc_id % 7 = 0
UNION ALL SELECT doc_id, 2 FROM texts WHERE contains(text, 'tion') AND lang IS DISTINCT FROM 'en'
UNION ALL SELECT doc_id, 3 FROM texts WHERE contains(text, 'é')
UNION ALL SELECT doc_id, 4 FROM texts WHERE n_chars >= 9000 OR n_chars <= 20
UNION ALL SELECT page_id + 1000000000000, 5 FROM pages WHERE contains(lower(url), '/es/') AND contains(lower(url), 'ht')""",
)
def _search_batches(t):
    """Answers replaced and taken away by a second batch, which is written twice."""
    path = f"{stage_dir(t.spark, 'jobs')}/index-{uuid.uuid4().hex}"
    written = document_answers(t).select("fingerprint", "question", "value")
    index_answers(written, path, 0)
    texts = t.read("documents").where(F.col("doc_id") % 7 <= 1)
    changed = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("Changed to "), F.col("doc_id").cast("string")))
    later = texts.select(F.col("doc_id").alias("fingerprint"), F.lit("description").alias("question"), changed.alias("value"))
    for _ in range(2):
        index_answers(later, path, 1)
    return search_indexed(t.spark, fingerprints(t), path, TEXT_SEARCHES)


@query(
    "search_hit_counts",
    with_views("stored_permissions", "search_hits")
    + "SELECT fingerprint, count(*) AS hits FROM search_hits GROUP BY fingerprint",
)
def _hit_counts(t):
    return searches(t).counts


@query(
    "unique_views",
    """SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS fingerprint, count(*) AS views,
       count(DISTINCT user_id) AS unique_views FROM events WHERE event_type = 'view' GROUP BY 1""",
)
def _unique_views(t):
    views = t.read("events").where(F.col("event_type") == "view").select(
        "user_id", F.get_json_object("props", "$.k").cast("long").alias("fingerprint")
    )
    return search.view_counts(views)


PERIODS = ("2024-01-16",)  # the first day of the second period


@query(
    "viewers_by_period",
    f"""WITH views AS (SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS fingerprint, user_id, ts >= TIMESTAMP '{PERIODS[0]}' AS late
    FROM events WHERE event_type = 'view'),
early AS (SELECT DISTINCT fingerprint, user_id FROM views WHERE NOT late),
later AS (SELECT DISTINCT fingerprint, user_id FROM views WHERE late),
shared AS (SELECT fingerprint, count(*) AS n FROM early JOIN later USING (fingerprint, user_id) GROUP BY 1)
SELECT fingerprint, count(DISTINCT user_id) AS unique_views, count(DISTINCT user_id) FILTER (WHERE NOT late) AS early_views,
    count(DISTINCT user_id) FILTER (WHERE late) AS late_views, coalesce(any_value(n), 0) AS shared
FROM views LEFT JOIN shared USING (fingerprint) GROUP BY 1""",
)
def _viewers_by_period(t):
    """Viewers of two periods and of both, from states per fingerprint and day that were stored in batches."""
    path = f"{stage_dir(t.spark, 'jobs')}/viewers-{uuid.uuid4().hex}"
    views = t.read("events").where(F.col("event_type") == "view").select(
        "user_id", "event_id", F.to_date("ts").alias("day"), F.get_json_object("props", "$.k").cast("long").alias("fingerprint")
    )
    for batch_id in (0, 1, 0):
        own = views.where(F.col("event_id") % 2 == batch_id)
        sketches.add_states(sketches.user_states(own, ["fingerprint", "day"]), path, batch_id)
    days, late = sketches.stored_states(t.spark, path), F.col("day") >= F.lit(PERIODS[0]).cast("date")
    whole, early, later = (sketches.merged_users(d, ["fingerprint"]) for d in (days, days.where(~late), days.where(late)))
    counted = [sketches.counted_users(s, ["fingerprint"]) for s in (whole, early, later)]
    named = [c.withColumnRenamed("unique_views", n) for c, n in zip(counted, ("unique_views", "early_views", "late_views"))]
    joined = named[0].join(named[1], "fingerprint", "left").join(named[2], "fingerprint", "left")
    joined = joined.join(sketches.shared_users(early, later, ["fingerprint"]), "fingerprint", "left")
    return joined.select("fingerprint", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("unique_views", "early_views", "late_views", "shared")])


VIEWS["exportable"] = """
SELECT a.fingerprint, a.question, a.value FROM answers a JOIN questions q ON a.questionnaire = q.questionnaire AND a.question = q.question
WHERE NOT EXISTS (SELECT 1 FROM stored_permissions p WHERE p.fingerprint = a.fingerprint
  AND p.question_set = q.question_set AND p.exportable = FALSE)"""


@query(
    "export_answers",
    with_views("exportable")
    + """SELECT fingerprint, question, '{"question":"' || question || '","data":' || CAST(to_json(value) AS VARCHAR) || '}'
  AS answer FROM exportable""",
)
def _export(t):
    return answers.answer_json(access.exportable_answers(document_answers(t), questions(t), stored_permissions(t)))


@query(
    "export_arrays",
    with_views("exportable")
    + """SELECT fingerprint, '[' || string_agg('{"question":"' || question || '","data":' ||
       CAST(to_json(value) AS VARCHAR) || '}', ',' ORDER BY question, value) || ']' AS answers
FROM exportable GROUP BY fingerprint""",
)
def _export_arrays(t):
    return answers.answers_array(access.exportable_answers(document_answers(t), questions(t), stored_permissions(t)))


@query(
    "html_escape",
    """SELECT page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'),
  '"', '&quot;'), '''', '&#x27;') AS escaped FROM pages""",
)
def _html_escape(t):
    return t.read("pages").select("page_id", html_escape(F.col("html")).alias("escaped"))

