"""One query per operator of the survey, over whole tables, and the equal SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataq import streaming
from strataq.functions import content_id, in_sample, normalised, only_letters
from strataq.operators import agent, answers, augment, difficulty, diversity, estimates, loop, merge, reconcile, review, surprise, sync, temporal
from strataq.sources import TABLES, load, shared_folder
from strataq.sources.service import TableService

Query = Callable[[SparkSession, str], DataFrame]


def table_sizes(spark: SparkSession, d: str) -> DataFrame:
    parts = [load(spark, d, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n") for t in TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _versions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Two versions of documents to synchronise: one lacks some rows, the other lacks and changes others."""
    docs = load(spark, d, "documents").select("doc_id", "text")
    current = docs.where("doc_id % 7 <> 0").withColumn("text", F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit(" (edited)"))).otherwise(F.col("text")))
    return current, docs.where("doc_id % 11 <> 0")


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return review.question_pairs(load(spark, d, "conversations"))


def _asked(spark: SparkSession, d: str) -> DataFrame:
    return agent.requests(_pairs(spark, d), "difficulty", "1", "question")


def _answers(spark: SparkSession, d: str) -> DataFrame:
    return agent.run_stage(spark, _asked(spark, d), f"{shared_folder(spark)}/responses")


def scored_difficulty(spark: SparkSession, d: str) -> DataFrame:
    return agent.parsed(_answers(spark, d)).select("request_id", F.coalesce(F.col("score").cast("bigint"), F.lit(-1)).alias("score"), F.when(~F.col("ok"), "unknown").when(F.col("score") < 34, "easy").when(F.col("score") < 67, "medium").otherwise("hard").alias("band"))


def pending_requests(spark: SparkSession, d: str) -> DataFrame:
    asked = _asked(spark, d)
    return agent.pending(asked, asked.where(in_sample(F.col("request_id"), 32768))).select("request_id")


def response_status(spark: SparkSession, d: str) -> DataFrame:
    answers = _answers(spark, d)
    return answers.select("request_id", "status", "body")


def parsed_responses(spark: SparkSession, d: str) -> DataFrame:
    return agent.parsed(_answers(spark, d)).select("request_id", "ok", F.coalesce(F.col("score").cast("bigint"), F.lit(-1)).alias("score"), "question")


_words = lambda text: F.regexp_count(text, F.lit("[^ \\t\\n\\r]+"))


def settled_questions(spark: SparkSession, d: str) -> DataFrame:
    """The loop over recorded answers: a conversation's first user turn is its question, its assistant turns are what came back, round by round.
    Answers of 170 words are good, those under 60 hopeless, others are the next draft; a draft costs its words, of which there are 200."""
    talk = load(spark, d, "conversations")
    questions = talk.where("role = 'user'").groupBy(F.col("conv_id").cast("string").alias("question_id")).agg(F.min_by("text", "turn").alias("draft"))
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn"))
    answers = talk.where("role = 'assistant'").select(F.col("conv_id").cast("string").alias("question_id"), number.alias("round"), F.col("text").alias("body"))

    def decide(body: Column, draft: Column) -> Column:
        status = F.when(_words(body) >= 170, "accepted").when(_words(body) < 60, "given_up").otherwise("open")
        return F.struct(status.alias("status"), F.when(status == "open", body).otherwise(draft).alias("draft"))

    return loop.refine(spark, questions, f"{shared_folder(spark)}/loop", loop.recorded(answers), decide, _words, 200)


def agreed_quality(spark: SparkSession, d: str) -> DataFrame:
    """What four reviewers of documents agree on, after two rounds: by length, by symbols, by lines, and the labels there are."""
    docs = load(spark, d, "documents").select("doc_id", "text", "n_chars")
    says = lambda name, good: F.struct(F.lit(name).alias("reviewer"), F.when(good, "good").otherwise("bad").alias("vote"))
    rules = [says("length", F.col("n_chars") >= 300), says("symbols", ~F.col("text").rlike("[|#*$%&]")), says("lines", F.col("text").contains("\n"))]
    votes = docs.select(F.col("doc_id").alias("item"), F.explode(F.array(*rules)).alias("x")).select("item", "x.*")
    labels = load(spark, d, "labels").select(F.col("doc_id").alias("item"), F.lit("labels").alias("reviewer"), F.when(F.col("quality") == 1, "good").otherwise("bad").alias("vote"))
    p, _ = estimates.agreement(votes.unionByName(labels), ["bad", "good"], 2, 0.0)
    return p.select(F.col("item").alias("doc_id"), "class", F.round("p", 6).alias("p"))


def difficulty_of_items(spark: SparkSession, d: str) -> DataFrame:
    """Difficulty after two rounds, of what users do by kind and hour: an event of a value from 35 is solved."""
    events = load(spark, d, "events")
    item = F.concat_ws("-", "event_type", F.hour("ts").cast("string"))
    items, _ = estimates.solve_difficulty(events.select(F.col("user_id").alias("solver"), item.alias("item"), (F.col("value") >= 35).alias("solved")), 2, 0.0)
    return items.select("item", F.round("difficulty", 6).alias("difficulty"), "n")


def surprising_questions(spark: SparkSession, d: str) -> DataFrame:
    """How surprising each question is to a model of three words counted over all documents."""
    model = surprise.counted(load(spark, d, "documents"), "text")
    found = surprise.surprise(_pairs(spark, d), ["conv_id", "turn"], "question", model)
    return found.select("conv_id", "turn", "words", F.round("bits", 6).alias("bits"))


_FIELDS = ("text_hash", "lang", "source")


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Local, remote and their last common version of documents: each side lacks, adds and edits other rows and fields."""
    docs = load(spark, d, "documents").select("doc_id", F.md5("text").alias("text_hash"), "lang", "source")
    edit = lambda df, field, every, value: df.withColumn(field, F.when(F.col("doc_id") % every == 0, value).otherwise(F.col(field)))
    local = edit(edit(docs.where("doc_id % 13 <> 0"), "text_hash", 5, F.concat("text_hash", F.lit("l"))), "lang", 6, F.lit("xx"))
    remote = edit(edit(docs.where("doc_id % 17 <> 0"), "text_hash", 10, F.concat("text_hash", F.lit("r"))), "source", 4, F.lit("moved"))
    return local, remote, docs.where("doc_id % 11 <> 0")


def reconciled_changes(spark: SparkSession, d: str) -> DataFrame:
    """The change set of y1, by digests of ranges that both sides keep."""
    current, previous = _versions(spark, d)
    one, other = (f"{shared_folder(spark)}/side" for _ in range(2))
    reconcile.keep(current, one)
    reconcile.keep(previous, other)
    return reconcile.reconciled(spark, one, other)


def sent_changes(spark: SparkSession, d: str) -> DataFrame:
    """Change rows sent through the service in their batches and read back from it."""
    current, previous = _versions(spark, d)
    spark.dataSource.register(TableService)
    path = shared_folder(spark)
    sync.send(sync.batches(sync.changes(current, previous)), path)
    return spark.read.format("table_service").option("path", path).load().select("doc_id", "op", "content_hash")


def pulled_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """The service holds one version, local is the other: what local has after a pull, and how each row came."""
    local, remote = _versions(spark, d)
    hashed = lambda df: df.select("doc_id", F.md5("text").alias("content_hash"))
    spark.dataSource.register(TableService)
    path = shared_folder(spark)
    sync.send(sync.batches(hashed(remote).withColumn("op", F.lit("insert"))), path)
    there = spark.read.format("table_service").option("path", path).load()
    return sync.pulled(there.select("doc_id", "content_hash"), hashed(local))


def incremental_events(spark: SparkSession, d: str) -> DataFrame:
    events = load(spark, d, "events")
    out, checkpoint = shared_folder(spark), shared_folder(spark)
    source = f"{d}/events.parque[t]" if "://" not in d else f"{d}/events.parquet"  # as a pattern it may be one file too
    streaming.incremental(spark, source, events.schema, out, checkpoint)
    return spark.read.schema(events.schema).parquet(f"{out}/*").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def applied_events(spark: SparkSession, d: str) -> DataFrame:
    """A user's last event that isn't an error, from events that come in three runs, out of order and some of them twice."""
    events = load(spark, d, "events")
    op = F.when(F.col("event_type") == "error", "delete").otherwise("upsert")
    given = events.select(F.col("user_id").cast("string").alias("key"), F.col("event_id").alias("version"), F.col("ts").cast("timestamp").alias("at"), op.alias("op"), F.col("event_type").alias("content"))
    source, out, checkpoint = (shared_folder(spark) for _ in range(3))
    for run in (2, 0, 1):
        given.where((F.col("version") % 3 == run) | (F.col("version") % 10 == 0)).write.mode("append").parquet(f"{source}/changes")
        streaming.apply_changes(spark, f"{source}/changes", out, checkpoint, late="366 days")
    return streaming.current_rows(spark, out).select(F.col("key").cast("bigint").alias("user_id"), F.col("version").alias("event_id"), F.col("content").alias("event_type"))


def typed_answers(spark: SparkSession, d: str) -> DataFrame:
    """Bodies of events in five forms (as they are, as text, nested, of another name, cut off): the number in each, or the path that failed."""
    events = load(spark, d, "events")
    k = F.regexp_extract("props", "[0-9]+", 0)
    drift = [F.concat(F.lit('{"k": "'), k, F.lit('"}')), F.concat(F.lit('{"k": {"value": '), k, F.lit("}}")), F.concat(F.lit('{"j": '), k, F.lit("}")), F.concat(F.lit('{"k": '), k)]
    body = F.col("props")
    for i, other in enumerate(drift):
        body = F.when(F.col("event_id") % 7 == i, other).otherwise(body)
    return answers.typed(events.select("event_id", body.alias("body")), "body", {"k": ("bigint", ["$.k", "$.k.value"])}).select("event_id", "k", "failed")


def views_before_purchases(spark: SparkSession, d: str) -> DataFrame:
    events = load(spark, d, "events")
    found = temporal.as_of(events.where("event_type = 'purchase'"), events.where("event_type = 'view'").withColumnRenamed("event_id", "view_id"), "user_id", "ts", ["view_id", "value"])
    return found.select("event_id", "user_id", F.col("last.view_id").alias("view_id"), F.col("last.value").alias("view_value"))


def errors_in_sessions(spark: SparkSession, d: str) -> DataFrame:
    """How many errors, of whomever, fall between the first and last event of each session that saw one."""
    events = load(spark, d, "events")
    lasting = events.groupBy(F.session_window("ts", "30 minutes"), "user_id").agg(F.min("ts").alias("first"), F.max("ts").alias("last")).select("user_id", "first", "last")
    errors = events.where("event_type = 'error'").select("event_id", F.col("ts").alias("first"), F.col("ts").alias("last"))
    return temporal.meeting(lasting, errors, "first", "last").groupBy("one.user_id", F.col("one.first").alias("start")).agg(F.count(F.lit(1)).alias("n_errors"))


def next_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """The new version as a written directory, which readers see whole or not at all."""
    current, previous = _versions(spark, d)
    path = f"{shared_folder(spark)}/snapshot"
    sync.applied(previous, current, sync.changes(current, previous)).write.parquet(path)
    return spark.read.parquet(path).select("doc_id", F.md5("text").alias("content_hash"))


def _docs(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: f(load(spark, d, "documents"))


def _on(f: Callable[[DataFrame], DataFrame], name: str) -> Query:
    return lambda spark, d: f(load(spark, d, name))


def _of_pairs(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: f(_pairs(spark, d))


QUERIES: dict[str, Query] = {
    "f1_table_sizes": table_sizes,
    "f2_normal_forms": _docs(lambda x: x.select("doc_id", F.md5(normalised(F.col("text"))).alias("spaced"), F.md5(only_letters(F.col("text"))).alias("letters"))),
    "f3_content_id": _docs(lambda x: x.select("doc_id", content_id(F.col("text")).alias("content_id"))),
    "f4_sample": _docs(lambda x: x.where(in_sample(F.col("doc_id"), 6554)).select("doc_id")),
    "q1_question_pairs": _pairs,
    "q2_review": _of_pairs(review.review),
    "q3_exact_duplicates": _docs(review.exact_duplicates_removed),
    "q4_near_duplicate_classes": _docs(review.near_duplicate_classes),
    "q5_contamination": lambda spark, d: review.contaminated(load(spark, d, "documents"), load(spark, d, "benchmark")),
    "q10_agreement": agreed_quality,
    "q6_personal_pattern": _docs(review.with_email),
    "q7_labelled": lambda spark, d: review.labelled(load(spark, d, "documents"), load(spark, d, "labels")),
    "q7_unlabelled": lambda spark, d: review.unlabelled(load(spark, d, "documents"), load(spark, d, "labels")),
    "q8_report": _docs(review.report),
    "q9_role_paths": _on(review.role_paths, "conversations"),
    "v1_features": _docs(difficulty.text_features),
    "v2_relative_bands": _on(difficulty.relative_bands, "conversations"),
    "v3_length_bands": _of_pairs(difficulty.length_bands),
    "v4_quantiles": _docs(difficulty.quantiles),
    "v5_scored_difficulty": scored_difficulty,
    "v6_centre_likeness": _on(difficulty.centre_likeness, "embeddings"),
    "v6_neighbours": _on(lambda x: difficulty.neighbours(x.where("vec_id % 50 = 0"), x), "embeddings"),
    "v7_solve_difficulty": difficulty_of_items,
    "v8_surprise": surprising_questions,
    "g1_seeds": _docs(agent.seeds),
    "g2_requests": lambda spark, d: _asked(spark, d).select("request_id", "stage", "payload"),
    "g3_pending": pending_requests,
    "g4_responses": response_status,
    "g5_parsed": parsed_responses,
    "g6_settled_questions": settled_questions,
    "g7_diverse_seeds": _on(lambda x: diversity.diverse(x, 10), "embeddings"),
    "g8_typed_answers": typed_answers,
    "a1_variants": _of_pairs(lambda x: augment.variants(x).select("question_id", "parent_id", "variant_no", "kind")),
    "a2_transforms": _of_pairs(lambda x: augment.variants(x).select("question_id", "question")),
    "a3_lineage": _of_pairs(augment.with_lineage),
    "a4_split": _of_pairs(lambda x: augment.split(augment.with_lineage(x))),
    "y1_changes": lambda spark, d: sync.changes(*_versions(spark, d)),
    "y2_batches": lambda spark, d: sync.batches(sync.changes(*_versions(spark, d))),
    "y3_sent_changes": sent_changes,
    "e2_views_before_purchases": views_before_purchases,
    "e3_errors_in_sessions": errors_in_sessions,
    "y10_applied": applied_events,
    "y4_incremental": incremental_events,
    "y5_next_snapshot": next_snapshot,
    "y6_pulled": pulled_snapshot,
    "y7_merged": lambda spark, d: merge.merged(*_sides(spark, d), "doc_id", _FIELDS),
    "y8_merge_conflicts": lambda spark, d: merge.conflicts(*_sides(spark, d), "doc_id", _FIELDS).where("field <> '*'"),
    "y9_reconciled": reconciled_changes,
    "e1_event_windows": _on(streaming.event_windows, "events"),
    "e1_sessions": _on(streaming.sessions, "events"),
}

_NORMAL = "trim(regexp_replace(lower({0}), '[ \\t\\n\\r]+', ' ', 'g'))"
_LETTERS = "trim(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
_N = _NORMAL.format
_PAIRS = """ahead AS (SELECT conv_id, turn, role, text AS question, lead(role) OVER w AS next_role, lead(text) OVER w AS answer FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
    pairs AS (SELECT conv_id, turn, question, answer FROM ahead WHERE role = 'user' AND next_role = 'assistant'),
    ids AS (SELECT *, md5(concat_ws('|', md5(""" + _N("question") + """), 'seed', conv_id, turn)) AS question_id FROM pairs)"""
_EMAIL = "'" + review.EMAIL.replace("(", "(?:") + "'"
_VERSIONS = """cur AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN text || ' (edited)' ELSE text END AS text FROM documents WHERE doc_id % 7 <> 0),
    prev AS (SELECT doc_id, text FROM documents WHERE doc_id % 11 <> 0),
    ch AS (SELECT * FROM (SELECT coalesce(c.doc_id, p.doc_id) AS doc_id,
        CASE WHEN p.doc_id IS NULL THEN 'insert' WHEN c.doc_id IS NULL THEN 'delete' WHEN md5(c.text) <> md5(p.text) THEN 'update' END AS op,
        coalesce(md5(c.text), md5(p.text)) AS content_hash FROM cur c FULL JOIN prev p ON c.doc_id = p.doc_id) WHERE op IS NOT NULL)"""
_SIDES = """docs AS (SELECT doc_id, md5(text) AS text_hash, lang, source FROM documents),
    loc AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN text_hash || 'l' ELSE text_hash END AS text_hash, CASE WHEN doc_id % 6 = 0 THEN 'xx' ELSE lang END AS lang, source FROM docs WHERE doc_id % 13 <> 0),
    rem AS (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN text_hash || 'r' ELSE text_hash END AS text_hash, lang, CASE WHEN doc_id % 4 = 0 THEN 'moved' ELSE source END AS source FROM docs WHERE doc_id % 17 <> 0),
    base AS (SELECT * FROM docs WHERE doc_id % 11 <> 0)"""
_LOOP_WORDS = "len(regexp_extract_all({0}, '[^ \\t\\n\\r]+'))".format
_OVER = f"s.spent + {_LOOP_WORDS('s.draft')} > 200"
_REQ = f"""{_PAIRS}, req AS (SELECT DISTINCT md5(concat_ws('|', 'difficulty', '1', md5(question))) AS request_id, 'difficulty' AS stage, question AS payload FROM pairs),
    ans AS (SELECT request_id, CAST('0x' || substr(md5(stage || '|' || payload), 1, 8) AS BIGINT) AS h FROM req)"""
_VARIANTS = f"""{_PAIRS}, var AS (SELECT question_id AS parent_id, unnest([{{'variant_no': 1::BIGINT, 'kind': 'lower', 'question': lower(question)}}, {{'variant_no': 2::BIGINT, 'kind': 'plain', 'question': {_N("question")}}},
    {{'variant_no': 3::BIGINT, 'kind': 'cued', 'question': 'Please answer: ' || question}}, {{'variant_no': 4::BIGINT, 'kind': 'short', 'question': substr(question, 1, 120)}}]) AS v FROM ids),
    made AS (SELECT md5(parent_id || '|' || v.variant_no) AS question_id, parent_id, v.variant_no AS variant_no, v.kind AS kind, v.question AS question FROM var),
    fam AS (SELECT question_id, CAST(NULL AS VARCHAR) AS parent_id, 0::BIGINT AS variant_no, 'seed' AS origin, question FROM ids UNION ALL SELECT question_id, parent_id, variant_no, 'augmented', question FROM made)"""

_AGREED = """WITH v AS (SELECT doc_id AS item, unnest([{'reviewer': 'length', 'good': n_chars >= 300}, {'reviewer': 'symbols', 'good': NOT regexp_matches(text, '[|#*$%&]')}, {'reviewer': 'lines', 'good': contains(text, chr(10))}]) AS x FROM documents),
    votes AS (SELECT item, x.reviewer AS reviewer, CASE WHEN x.good THEN 'good' ELSE 'bad' END AS vote FROM v UNION ALL SELECT doc_id, 'labels', CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END FROM labels),
    classes AS (SELECT unnest(['bad', 'good']) AS class), n AS (SELECT count(DISTINCT item) AS n FROM votes),
    p0 AS (SELECT item, class, CAST(count(*) FILTER (vote = class) AS DOUBLE) / count(*) AS p FROM votes, classes GROUP BY item, class)"""
for _r in range(2):
    _AGREED += f""", c{_r} AS (SELECT r.reviewer, c.class, w.class AS vote, coalesce(sum(p.p) FILTER (v.vote = w.class), 0) + 0.01::DOUBLE AS s FROM (SELECT DISTINCT reviewer FROM votes) r, classes c, classes w
        LEFT JOIN votes v ON v.reviewer = r.reviewer LEFT JOIN p{_r} p ON p.item = v.item AND p.class = c.class GROUP BY ALL),
    h{_r} AS (SELECT reviewer, class, vote, s / sum(s) OVER (PARTITION BY reviewer, class) AS share FROM c{_r}),
    b{_r} AS (SELECT class, (sum(p) + 0.01::DOUBLE) / (any_value(n) + 0.02::DOUBLE) AS prior FROM p{_r}, n GROUP BY class),
    l{_r} AS (SELECT v.item, h.class, sum(ln(share)) + ln(any_value(prior)) AS l FROM votes v JOIN h{_r} h ON h.reviewer = v.reviewer AND h.vote = v.vote JOIN b{_r} b ON b.class = h.class GROUP BY v.item, h.class),
    w{_r} AS (SELECT item, class, exp(l - max(l) OVER (PARTITION BY item)) AS w FROM l{_r}), p{_r + 1} AS (SELECT item, class, w / sum(w) OVER (PARTITION BY item) AS p FROM w{_r})"""
_SOLVED = """WITH a AS (SELECT user_id AS solver, event_type || '-' || hour(ts) AS item, CASE WHEN value >= 35 THEN 1.0::DOUBLE ELSE 0 END AS y FROM events),
    i0 AS (SELECT item, 0.0::DOUBLE AS x, count(*) AS n FROM a GROUP BY item), s0 AS (SELECT DISTINCT solver, 0.0::DOUBLE AS x FROM a)"""
_STEP = "greatest(-2.0::DOUBLE, least(2.0::DOUBLE, ({0} * sum(y - p) - any_value(x)) / (sum(p * (1 - p)) + 1)))".format
for _r in range(2):
    _SOLVED += f""", s{_r + 1} AS (SELECT solver, any_value(x) + {_STEP(1)} AS x FROM (SELECT a.solver, y, s.x AS x, 1 / (1 + exp(i.x - s.x)) AS p FROM a JOIN s{_r} s USING (solver) JOIN i{_r} i USING (item)) GROUP BY solver),
    i{_r + 1} AS (SELECT item, any_value(x) + {_STEP(-1)} AS x, any_value(n) AS n FROM (SELECT a.item, y, i.x AS x, n, 1 / (1 + exp(i.x - s.x)) AS p FROM a JOIN s{_r + 1} s USING (solver) JOIN i{_r} i USING (item)) GROUP BY item)"""

_RUNS = """SELECT {0} CASE WHEN length(a) > 64 THEN sha256(a) ELSE a END AS a, CASE WHEN length(b) > 64 THEN sha256(b) ELSE b END AS b, CASE WHEN length(c) > 64 THEN sha256(c) ELSE c END AS c
        FROM (SELECT {0} unnest(t[:-3]) AS a, unnest(t[2:-2]) AS b, unnest(t[3:]) AS c FROM (SELECT {0} [chr(10), chr(10)] || regexp_extract_all(lower({1}), '[^ \\t\\n\\r]+') AS t FROM {2}) WHERE len(t) > 2)""".format
_DISCOUNT = "(SELECT count(*) FILTER (n = 1) / (count(*) FILTER (n = 1) + 2.0::DOUBLE * count(*) FILTER (n = 2)) FROM {0})".format
_SURPRISE = f"""{_PAIRS}, runs AS ({_RUNS('', 'text', 'documents')}),
    n3 AS (SELECT a, b, c, count(*) AS n FROM runs GROUP BY ALL), n2 AS (SELECT b, c, count(*) AS n FROM n3 GROUP BY ALL), n1 AS (SELECT c, count(*) AS n FROM n2 GROUP BY ALL),
    s3 AS (SELECT a, b, sum(n) AS total, count(*) AS kinds FROM n3 GROUP BY ALL), s2 AS (SELECT b, sum(n) AS total, count(*) AS kinds FROM n2 GROUP BY ALL),
    d AS (SELECT {_DISCOUNT('n3')} AS d3, {_DISCOUNT('n2')} AS d2, {_DISCOUNT('n1')} AS d1, (SELECT sum(n) FROM n1) AS total, (SELECT count(*) FROM n1) AS kinds),
    asked AS ({_RUNS('conv_id, turn,', 'question', 'pairs')}),
    q AS (SELECT q.conv_id, q.turn, (greatest(coalesce(n1.n, 0) - d1, 0) + d1 * d.kinds / (d.kinds + 1)) / d.total AS p1,
        CASE WHEN s2.total IS NULL THEN p1 ELSE (greatest(coalesce(n2.n, 0) - d2, 0) + d2 * s2.kinds * p1) / s2.total END AS p2,
        CASE WHEN s3.total IS NULL THEN p2 ELSE (greatest(coalesce(n3.n, 0) - d3, 0) + d3 * s3.kinds * p2) / s3.total END AS p3
        FROM asked q CROSS JOIN d LEFT JOIN n1 USING (c) LEFT JOIN n2 USING (b, c) LEFT JOIN n3 USING (a, b, c) LEFT JOIN s2 USING (b) LEFT JOIN s3 USING (a, b)),
    sums AS (SELECT conv_id, turn, count(*) AS words, avg(-log2(p3)) AS bits FROM q GROUP BY ALL)"""

ORACLES: dict[str, str] = {
    "f1_table_sizes": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in TABLES),
    "f2_normal_forms": f"SELECT doc_id, md5({_N('text')}) AS spaced, md5({_LETTERS.format('text')}) AS letters FROM documents",
    "f3_content_id": f"SELECT doc_id, md5({_N('text')}) AS content_id FROM documents",
    "f4_sample": "SELECT doc_id FROM documents WHERE substr(md5(CAST(doc_id AS VARCHAR)), 1, 4) < '199a'",
    "q1_question_pairs": f"WITH {_PAIRS} SELECT * FROM pairs",
    "q2_review": f"""WITH {_PAIRS}, r AS (SELECT question_id, list_filter([CASE WHEN trim(question) = '' OR trim(answer) = '' THEN 'empty' END, CASE WHEN length(answer) < 20 THEN 'short' END,
        CASE WHEN length(answer) > 4000 THEN 'long' END, CASE WHEN {_N('question')} = {_N('answer')} THEN 'echo' END,
        CASE WHEN regexp_matches(question, {_EMAIL}) OR regexp_matches(answer, {_EMAIL}) THEN 'personal' END], lambda x: x IS NOT NULL) AS why FROM ids)
        SELECT question_id, len(why) = 0 AS passed, array_to_string(why, ',') AS reasons FROM r""",
    "q3_exact_duplicates": "SELECT sha256(text) AS text_id, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text",
    "q4_near_duplicate_classes": f"""WITH t AS (SELECT doc_id, text, list_filter(string_split({_LETTERS.format('text')}, ' '), lambda w: w <> '') AS w FROM documents),
        s AS (SELECT doc_id, text, CASE WHEN len(w) >= 5 THEN list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS items FROM t),
        c AS (SELECT min(doc_id) AS class_id, items, CASE WHEN items IS NULL THEN text END AS own, list(doc_id) AS docs FROM s GROUP BY items, own),
        e AS (SELECT class_id, len(items) AS size, unnest(items) AS item FROM c WHERE items IS NOT NULL),
        p AS (SELECT a.class_id AS a, b.class_id AS b, any_value(a.size) AS na, any_value(b.size) AS nb, count(*) AS common FROM e a JOIN e b ON a.item = b.item AND a.class_id <> b.class_id GROUP BY ALL),
        l AS (SELECT a, count(*) AS n FROM p WHERE 100 * common >= 80 * (na + nb - common) GROUP BY a)
        SELECT unnest(docs) AS doc_id, class_id, coalesce(l.n, 0) AS n_links FROM c LEFT JOIN l ON c.class_id = l.a""",
    "q5_contamination": "SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text) WHERE b.text <> ''",
    "q10_agreement": f"{_AGREED} SELECT item AS doc_id, class, round(p, 6) AS p FROM p2",
    "q6_personal_pattern": f"SELECT doc_id FROM documents WHERE regexp_matches(text, {_EMAIL})",
    "q7_labelled": "SELECT coalesce(l.quality, -1) AS quality, count(*) AS n, CAST(sum(d.n_chars) AS BIGINT) AS chars FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY ALL",
    "q7_unlabelled": "SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)",
    "q8_report": "SELECT lang, source, CAST(grouping(lang, source) AS BIGINT) AS level, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY CUBE (lang, source)",
    "q9_role_paths": "SELECT conv_id, string_agg(role, '>' ORDER BY turn) AS path FROM conversations GROUP BY conv_id",
    "v1_features": "SELECT doc_id, length(text) AS chars, len(string_split(text, ' ')) AS words, round(ln(len(string_split(text, ' '))), 6) AS log_words FROM documents",
    "v2_relative_bands": "SELECT conv_id, turn, ntile(5) OVER w AS band, round(percent_rank() OVER w, 6) AS rank FROM conversations WINDOW w AS (PARTITION BY role ORDER BY length(text), conv_id, turn)",
    "v3_length_bands": f"WITH {_PAIRS} SELECT conv_id, turn, length(answer) AS answer_chars, CASE WHEN length(answer) < 500 THEN 'short' WHEN length(answer) < 1000 THEN 'medium' ELSE 'long' END AS band FROM pairs",
    "v4_quantiles": "SELECT lang, quantile_cont(n_chars, 0.5) AS median, quantile_cont(n_chars, 0.9) AS decile9 FROM documents GROUP BY lang",
    "v5_scored_difficulty": f"WITH {_REQ} SELECT request_id, CASE WHEN h % 13 <> 0 THEN h % 100 ELSE -1 END AS score, CASE WHEN h % 13 = 0 THEN 'unknown' WHEN h % 100 < 34 THEN 'easy' WHEN h % 100 < 67 THEN 'medium' ELSE 'hard' END AS band FROM ans",
    "v6_centre_likeness": """WITH x AS (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding) AS x FROM embeddings), m AS (SELECT label, i, avg(x::DOUBLE) AS m FROM x GROUP BY label, i),
        c AS (SELECT label, list(m ORDER BY i) AS c FROM m GROUP BY label)
        SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], c) / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) * list_dot_product(c, c)), 5) AS likeness FROM embeddings JOIN c USING (label)""",
    "v6_neighbours": """WITH s AS (SELECT q.vec_id AS query_id, r.vec_id, round(list_dot_product(q.embedding::DOUBLE[], r.embedding::DOUBLE[])
          / sqrt(list_dot_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[]) * list_dot_product(r.embedding::DOUBLE[], r.embedding::DOUBLE[])), 5) AS likeness
        FROM embeddings q JOIN embeddings r ON q.vec_id <> r.vec_id WHERE q.vec_id % 50 = 0)
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY likeness DESC, vec_id) AS rank, vec_id, likeness FROM s QUALIFY rank <= 5""",
    "v7_solve_difficulty": f"{_SOLVED} SELECT item, round(x, 6) AS difficulty, n FROM i2",
    "v8_surprise": f"WITH {_SURPRISE} SELECT conv_id, turn, coalesce(words, 0) AS words, round(coalesce(bits, 0), 6) AS bits FROM pairs LEFT JOIN sums USING (conv_id, turn)",
    "g1_seeds": "SELECT doc_id, source, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents QUALIFY rank <= 3",
    "g2_requests": f"WITH {_REQ} SELECT * FROM req",
    "g3_pending": f"WITH {_REQ} SELECT request_id FROM req WHERE NOT substr(md5(request_id), 1, 4) < '8000'",
    "g4_responses": f"""WITH {_REQ} SELECT request_id, 'done' AS status, CASE WHEN h % 13 = 0 THEN 'sorry' ELSE '{{"score": ' || (h % 100) || ', "question": "Q' || (h % 1000) || '"}}' END AS body FROM ans""",
    "g5_parsed": f"WITH {_REQ} SELECT request_id, h % 13 <> 0 AS ok, CASE WHEN h % 13 <> 0 THEN h % 100 ELSE -1 END AS score, CASE WHEN h % 13 <> 0 THEN 'Q' || (h % 1000) END AS question FROM ans",
    "g6_settled_questions": f"""WITH RECURSIVE a AS (SELECT conv_id, text AS body, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS round FROM conversations WHERE role = 'assistant'),
        s AS (SELECT conv_id, min_by(text, turn) AS draft, 0 AS rounds, 0::BIGINT AS spent, 'open' AS status FROM conversations WHERE role = 'user' GROUP BY conv_id
          UNION ALL SELECT s.conv_id, CASE WHEN {_OVER} OR NOT {_LOOP_WORDS('a.body')} BETWEEN 60 AND 169 THEN s.draft ELSE coalesce(a.body, s.draft) END, CASE WHEN {_OVER} THEN s.rounds ELSE s.rounds + 1 END,
            CASE WHEN {_OVER} THEN s.spent ELSE s.spent + {_LOOP_WORDS('s.draft')} END,
            CASE WHEN {_OVER} THEN 'over_budget' WHEN a.body IS NULL THEN 'unanswered' WHEN {_LOOP_WORDS('a.body')} >= 170 THEN 'accepted' WHEN {_LOOP_WORDS('a.body')} < 60 THEN 'given_up' ELSE 'open' END
          FROM s LEFT JOIN a ON a.conv_id = s.conv_id AND a.round = s.rounds + 1 WHERE s.status = 'open' AND s.rounds < 8)
        SELECT CAST(conv_id AS VARCHAR) AS question_id, status, rounds, spent, draft FROM s QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY status <> 'open' DESC, rounds DESC) = 1""",
    "a1_variants": f"WITH {_VARIANTS} SELECT question_id, parent_id, variant_no, kind FROM made",
    "a2_transforms": f"WITH {_VARIANTS} SELECT question_id, question FROM made",
    "a3_lineage": f"WITH {_VARIANTS} SELECT * FROM fam",
    "a4_split": f"WITH {_VARIANTS} SELECT question_id, CASE WHEN substr(md5(coalesce(parent_id, question_id)), 1, 4) < '199a' THEN 'test' ELSE 'train' END AS part FROM fam",
    "y1_changes": f"WITH {_VERSIONS} SELECT * FROM ch",
    "y2_batches": f"WITH {_VERSIONS}, l AS (SELECT *, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 12) AS BIGINT) % (SELECT greatest(1, CAST(ceil(count(*) / 10000) AS BIGINT)) FROM ch) AS lane FROM ch) SELECT *, (row_number() OVER (PARTITION BY lane ORDER BY doc_id) - 1) // 100 AS batch_no FROM l",
    "y3_sent_changes": f"WITH {_VERSIONS} SELECT * FROM ch",
    "y4_incremental": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
    "y5_next_snapshot": f"WITH {_VERSIONS} SELECT doc_id, md5(text) AS content_hash FROM cur",
    "y6_pulled": f"""WITH {_VERSIONS} SELECT p.doc_id, md5(p.text) AS content_hash, CASE WHEN c.doc_id IS NULL THEN 'insert' WHEN md5(c.text) = md5(p.text) THEN 'same' ELSE 'update' END AS op
        FROM prev p LEFT JOIN cur c ON c.doc_id = p.doc_id""",
    "y7_merged": f"""WITH {_SIDES} SELECT coalesce(l.doc_id, r.doc_id) AS doc_id, CASE WHEN r.doc_id IS NULL THEN l.text_hash WHEN l.doc_id IS NULL OR b.doc_id IS NULL OR r.text_hash <> b.text_hash THEN r.text_hash ELSE l.text_hash END AS text_hash, CASE WHEN r.doc_id IS NULL THEN l.lang WHEN l.doc_id IS NULL OR b.doc_id IS NULL OR r.lang <> b.lang THEN r.lang ELSE l.lang END AS lang, CASE WHEN r.doc_id IS NULL THEN l.source WHEN l.doc_id IS NULL OR b.doc_id IS NULL OR r.source <> b.source THEN r.source ELSE l.source END AS source
        FROM loc l FULL JOIN rem r USING (doc_id) LEFT JOIN base b ON b.doc_id = coalesce(l.doc_id, r.doc_id) WHERE NOT coalesce((l.doc_id IS NULL AND b.doc_id IS NOT NULL AND (r.text_hash, r.lang, r.source) = (b.text_hash, b.lang, b.source)) OR (r.doc_id IS NULL AND b.doc_id IS NOT NULL AND (l.text_hash, l.lang, l.source) = (b.text_hash, b.lang, b.source)), false)""",
    "y8_merge_conflicts": f"""WITH {_SIDES}, j AS (SELECT l.doc_id, unnest([{{'field': 'text_hash', 'b': b.text_hash, 'l': l.text_hash, 'r': r.text_hash}}, {{'field': 'lang', 'b': b.lang, 'l': l.lang, 'r': r.lang}}, {{'field': 'source', 'b': b.source, 'l': l.source, 'r': r.source}}]) AS c
          FROM loc l JOIN rem r USING (doc_id) LEFT JOIN base b USING (doc_id))
        SELECT doc_id, c.field AS field, c.b AS base_value, c.l AS local_value, c.r AS remote_value FROM j WHERE c.l <> c.r AND c.l IS DISTINCT FROM c.b AND c.r IS DISTINCT FROM c.b""",
    "y9_reconciled": f"WITH {_VERSIONS} SELECT * FROM ch",
    "e1_event_windows": "SELECT time_bucket(INTERVAL 1 day, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    "e1_sessions": """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 minutes THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g) SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""",
    "e2_views_before_purchases": """WITH v AS (SELECT user_id, ts, max(event_id) AS view_id, max_by(value, event_id) AS value FROM events WHERE event_type = 'view' GROUP BY ALL)
        SELECT p.event_id, p.user_id, v.view_id, v.value AS view_value FROM (FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts""",
    "e3_errors_in_sessions": """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 minutes THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        k AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g), s AS (SELECT user_id, min(ts) AS start, max(ts) AS last FROM k GROUP BY user_id, k)
        SELECT s.user_id, s.start, count(*) AS n_errors FROM s JOIN events e ON e.event_type = 'error' AND e.ts BETWEEN s.start AND s.last GROUP BY ALL""",
    "y10_applied": "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1 AND event_type <> 'error'",
    "g8_typed_answers": r"""WITH b AS (SELECT event_id, regexp_extract(props, '[0-9]+') AS k, props FROM events),
        f AS (SELECT event_id, CASE event_id % 7 WHEN 0 THEN '{"k": "' || k || '"}' WHEN 1 THEN '{"k": {"value": ' || k || '}}' WHEN 2 THEN '{"j": ' || k || '}' WHEN 3 THEN '{"k": ' || k ELSE props END AS body FROM b),
        r AS (SELECT event_id, CASE WHEN json_valid(body) THEN body END AS body FROM f),
        t AS (SELECT event_id, body, coalesce(TRY_CAST(json_extract_string(body, '$.k') AS BIGINT), TRY_CAST(json_extract_string(body, '$.k.value') AS BIGINT)) AS k FROM r)
        SELECT event_id, k, CASE WHEN body IS NULL THEN '$' WHEN k IS NULL THEN '$.k' END AS failed FROM t""",
}
