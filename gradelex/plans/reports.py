"""Queries of the response and report functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradelex.functions import responses, rules
from gradelex.functions.rules import TARGETS
from gradelex.operators import gates, reports, state
from gradelex.plans.base import UPOS_LIST, Registry, entries, with_entry
from gradelex.session import table

R = Registry()
QUERIES, SQL = R.queries, R.sql


def _bodies(spark, d):
    """Decisions as the answers of two kinds of model."""
    r = table(spark, d, "review_decision").select("decision_id", "reviewer", F.col("expected.lemma").alias("w"), F.length("expected.lemma").alias("n"))
    n = F.coalesce("n", F.lit(0))
    a = F.to_json(F.struct(F.array(F.struct(F.struct(F.col("w").alias("content")).alias("message"))).alias("choices"), F.struct(n.alias("prompt_tokens"), (n * 2).alias("completion_tokens"), (n * 3).alias("total_tokens")).alias("usage")))
    b = F.to_json(F.struct(F.array(F.struct(F.struct(F.array(F.struct(F.lit("hm").alias("text"), F.lit(True).alias("thought")), F.struct(F.col("w").alias("text"), F.lit(None).cast("boolean").alias("thought"))).alias("parts")).alias("content"))).alias("candidates"), F.struct(n.alias("promptTokenCount"), (n * 2).alias("candidatesTokenCount"), (n * 3).alias("totalTokenCount")).alias("usageMetadata")))
    return r.withColumn("body", F.when(F.col("reviewer") < "reviewer-05", a).otherwise(b))


@R.add("response_content", "SELECT decision_id, nullif(expected.lemma, '') AS content FROM review_decision WHERE expected.lemma <> ''")
def response_content(spark, d):
    return _bodies(spark, d).where("w <> ''").select("decision_id", responses.content(F.col("body")).alias("content"))


@R.add("usage_totals", "SELECT reviewer, CAST(sum(coalesce(length(expected.lemma), 0)) AS BIGINT) AS prompt, CAST(2 * sum(coalesce(length(expected.lemma), 0)) AS BIGINT) AS candidate, CAST(3 * sum(coalesce(length(expected.lemma), 0)) AS BIGINT) AS total FROM review_decision GROUP BY ALL")
def usage_totals(spark, d):
    return reports.usage_totals(_bodies(spark, d), "reviewer", "body")


@R.add("action_histogram", "SELECT round, action, count(*) AS n FROM review_decision GROUP BY ALL")
def action_histogram(spark, d):
    return reports.histogram(table(spark, d, "review_decision"), "round", "action")


@R.add("reject_reasons", "SELECT round, reason, count(*) AS n FROM review_decision WHERE action = 'drop' GROUP BY ALL")
def reject_reasons(spark, d):
    return reports.histogram(table(spark, d, "review_decision").where("action = 'drop'"), "round", "reason")


@R.add("slot_hints", "SELECT raw_id, line_no AS slot, raw_id % 7 AS round, (['food', 'travel', 'work', 'home', 'nature'])[CAST((line_no + raw_id % 7 * 3) % 5 AS INT) + 1] AS hint FROM raw_line")
def slot_hints(spark, d):
    r = table(spark, d, "raw_line").withColumn("id", F.concat(F.lit("novel:slot:"), "line_no", F.lit(":round:"), F.col("raw_id") % 7))
    sr = responses.slot_round(F.col("id"))
    return r.withColumn("x", sr).select("raw_id", "x.slot", F.col("x.round").cast("bigint").alias("round"), responses.hint(["food", "travel", "work", "home", "nature"], F.col("x.slot"), F.col("x.round"), 3).alias("hint"))


@R.add("payload_items", "SELECT decision_id, expected.lemma AS lemma, action FROM review_decision WHERE expected.lemma IS NOT NULL")
def payload_items(spark, d):
    row = F.array(F.struct(F.col("expected.lemma").alias("lemma"), F.col("action").alias("action")))
    r = table(spark, d, "review_decision").where("expected.lemma is not null").withColumn("p", F.when(F.col("action") == "fix", F.to_json(F.struct(row.alias("rows")))).when(F.col("action") == "drop", F.to_json(F.struct(row.alias("concepts")))).otherwise(F.to_json(row)))
    return r.select("decision_id", F.explode(responses.items(F.col("p"), "struct<lemma:string,action:string>")).alias("x")).select("decision_id", "x.lemma", "x.action")


@R.add("task_config", "SELECT DISTINCT '{\"lang\":\"' || lang || '\",\"level\":\"' || level || '\",\"target\":' || CASE level WHEN 'A1' THEN 600 WHEN 'A2' THEN 600 WHEN 'B1' THEN 1000 WHEN 'B2' THEN 2000 ELSE 4000 END || '}' AS config FROM level_entry")
def task_config(spark, d):
    target = F.element_at(F.create_map(*[F.lit(x) for kv in TARGETS.items() for x in kv]), F.col("level"))
    return entries(spark, d).select("lang", "level").distinct().select(responses.canonical_json({"level": F.col("level"), "target": target, "lang": F.col("lang")}).alias("config"))


@R.add("retriable_reasons", "SELECT o_orderkey, coalesce(regexp_matches(lower(e), 'timeout|timed out|rate limit|429|500|502|503|504|overloaded|connection'), false) AS again FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'Connection reset' WHEN o_orderkey % 9 = 1 THEN 'Read TIMEOUT' WHEN o_orderkey % 9 = 2 THEN NULL ELSE 'HTTP ' || (400 + o_orderkey % 106) END AS e FROM orders)")
def retriable_reasons(spark, d):
    """Order keys as the error messages of a server."""
    k = F.col("o_orderkey")
    error = F.when(k % 9 == 0, "Connection reset").when(k % 9 == 1, "Read TIMEOUT").when(k % 9 > 2, F.concat(F.lit("HTTP "), 400 + k % 106))
    return table(spark, d, "orders").select("o_orderkey", responses.retriable(error).alias("again"))


@R.add("action_sample", "SELECT decision_id, action, reason FROM review_decision ORDER BY decision_id LIMIT 12")
def action_sample(spark, d):
    return table(spark, d, "review_decision").select("decision_id", "action", "reason").orderBy("decision_id").limit(12)


@R.add("flat_items", "SELECT decision_id, expected.upos AS key, expected.lemma AS value FROM review_decision WHERE expected.lemma IS NOT NULL AND expected.upos IS NOT NULL")
def flat_items(spark, d):
    r = table(spark, d, "review_decision").where("expected.lemma is not null and expected.upos is not null").withColumn("p", F.to_json(F.create_map("expected.upos", "expected.lemma")))
    return r.select("decision_id", F.explode(responses.flat_items(F.col("p"))).alias("x")).select("decision_id", "x.key", "x.value")


_TASKS = "tk AS (SELECT o_orderkey, 'task-' || o_orderkey AS task_key, CASE o_orderkey % 3 WHEN 0 THEN 'cefr' ELSE 'handcraft' END AS phase, (['ar', 'de', 'en', 'fr'])[CAST(o_orderkey % 4 AS INT) + 1] AS lang, (['A1', 'A2', 'B1', 'B2', 'C1'])[CAST(o_orderkey % 5 AS INT) + 1] AS level, CASE o_orderstatus WHEN 'O' THEN 'succeeded' WHEN 'F' THEN 'failed' ELSE 'pending' END AS status, CASE WHEN o_orderkey % 2 = 0 THEN 'out/' || o_orderkey ELSE '' END AS output, o_orderdate AS updated_at FROM orders)"


def _tasks(spark, d):
    """Orders as the tasks of a run."""
    k = F.col("o_orderkey")
    pick = lambda values, n: F.element_at(F.array(*[F.lit(v) for v in values]), (k % n + 1).cast("int"))
    status = F.when(F.col("o_orderstatus") == "O", "succeeded").when(F.col("o_orderstatus") == "F", "failed").otherwise("pending")
    return table(spark, d, "orders").select(F.concat(F.lit("task-"), k).alias("task_key"), F.when(k % 3 == 0, "cefr").otherwise("handcraft").alias("phase"), pick(["ar", "de", "en", "fr"], 4).alias("lang"), pick(["A1", "A2", "B1", "B2", "C1"], 5).alias("level"), status.alias("status"), F.when(k % 2 == 0, F.concat(F.lit("out/"), k)).otherwise("").alias("output"), F.col("o_orderdate").alias("updated_at"))


@R.add("succeeded_tasks", f"WITH {_TASKS} SELECT lang, level, coalesce(nullif(output, ''), lang || '/' || level || '.proposed.csv') AS output FROM tk WHERE phase = 'cefr' AND status = 'succeeded' AND lang IN ('de', 'fr')")
def succeeded_tasks(spark, d):
    return reports.succeeded_tasks(_tasks(spark, d), "cefr", ["de", "fr"])


@R.add("failed_tasks", f"WITH {_TASKS} SELECT task_key, phase, updated_at FROM tk WHERE status = 'failed'")
def failed_tasks(spark, d):
    return reports.tasks_by_status(_tasks(spark, d), "failed").select("task_key", "phase", "updated_at")


@R.add("runnable_tasks", f"WITH {_TASKS}, f AS (SELECT lang, level, min(CASE phase WHEN 'cefr' THEN 1 ELSE 2 END) AS step FROM tk WHERE status <> 'succeeded' GROUP BY ALL) SELECT task_key, CAST(step AS INT) AS step FROM tk JOIN f USING (lang, level) WHERE status IN ('pending', 'failed') AND step = CASE phase WHEN 'cefr' THEN 1 ELSE 2 END")
def runnable_tasks(spark, d):
    return state.runnable(_tasks(spark, d), ["cefr", "handcraft"], retry_failed=True).select("task_key", "step")


@R.add("log_lines", "SELECT event_id AS ord, strftime(ts, '%Y-%m-%d %H:%M:%S') || ' ' || CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO ' END || ' ' || event_type || ' user=' || user_id || ' value=' || CASE WHEN value < 10 THEN 'low' ELSE 'high' END AS line FROM events WHERE value IS NOT NULL")
def log_lines(spark, d):
    e = table(spark, d, "events").where("value is not null")
    fields = F.create_map(F.lit("value"), F.when(F.col("value") < 10, "low").otherwise("high"), F.lit("user"), F.col("user_id").cast("string"))
    return reports.log_line(e.select(F.col("event_id").alias("ord"), F.col("ts").alias("at"), F.when(F.col("event_type") == "error", "error").otherwise("info").alias("level"), F.col("event_type").alias("name"), fields.alias("fields")))


@R.add("readiness", with_entry("SELECT lang, level, n_rows, required, least(coalesce(k, 0), 20) AS n_issues, n_rows >= required AND coalesce(k, 0) = 0 AS ready FROM (SELECT lang, level, count(*) AS n_rows FROM entry GROUP BY ALL) JOIN (VALUES ('A1', 600::BIGINT), ('A2', 600), ('B1', 1000), ('B2', 2000), ('C1', 4000)) t(level, required) USING (level) LEFT JOIN (SELECT lang, level, count(*) AS k FROM entry WHERE trim(english) = '' GROUP BY ALL) USING (lang, level)"))
def readiness(spark, d):
    e = entries(spark, d)
    issues = gates.schema_problems(e, ["english"]).where("field = 'english'").join(e.select("ord", "lang", "level"), "ord").select("lang", "level", F.col("problem").alias("code"))
    required = F.broadcast(spark.createDataFrame(list(TARGETS.items()), "level string, required bigint"))  # five rows
    return reports.readiness(e, issues, required, ("control",))


@R.add("blocking_issues", with_entry(f"SELECT lang, level, ord, code, CAST(row_number() OVER (PARTITION BY lang, level ORDER BY ord, code) AS INT) AS place FROM (SELECT lang, level, ord, 'unknown tag' AS code FROM entry WHERE pos NOT IN ({UPOS_LIST}) UNION ALL SELECT lang, level, ord, 'empty' FROM entry WHERE trim(english) = '') QUALIFY place <= 20"))
def blocking_issues(spark, d):
    e = entries(spark, d)
    found = e.select("lang", "level", "ord", F.when(~rules.known_upos(F.col("pos")), "unknown tag").alias("code")).where("code is not null")
    blank = e.select("lang", "level", "ord", rules.text_problem(F.col("english")).alias("code")).where("code is not null")
    return reports.blocking_issues(found.unionByName(blank), ("control",))


@R.add("blocked_tasks", "WITH t AS (SELECT DISTINCT lang, level FROM level_entry), s AS (SELECT 'cefr' AS phase, lang, level, CASE WHEN level = 'A1' THEN 'succeeded' ELSE 'failed' END AS status FROM t) SELECT 'handcraft:' || lang || ':' || level AS task_key FROM s WHERE status <> 'succeeded'")
def blocked_tasks(spark, d):
    t = entries(spark, d).select("lang", "level").distinct()
    both = t.select(F.explode(F.array(F.lit("cefr"), F.lit("handcraft"))).alias("phase"), "lang", "level")
    tasks = both.select("phase", "lang", "level", F.concat_ws(":", "phase", "lang", "level").alias("task_key"), F.when(F.col("level") == "A1", "succeeded").otherwise("failed").alias("status"))
    return reports.blocked_tasks(tasks, "cefr", "handcraft")


@R.add("request_bodies", with_entry("SELECT ord, to_json({'model': 'm-' || level, 'messages': [{'role': 'system', 'content': 'Judge words.'}, {'role': 'user', 'content': 'Is ' || lemma || ' a ' || pos || ' for ' || english || '? {yes}'}], 'max_tokens': 100 + length(lemma)})::VARCHAR AS body FROM entry"))
def request_bodies(spark, d):
    prompt = responses.filled("Is {word} a {tag} for {gloss}? {yes}", word=F.col("lemma"), tag=F.col("pos"), gloss=F.col("english"))
    return entries(spark, d).select("ord", responses.request(F.concat(F.lit("m-"), "level"), F.lit("Judge words."), prompt, 100 + F.length("lemma")).alias("body"))


@R.add("model_text", with_entry("SELECT ord, trim(lemma || ' is kept') AS shown, '{\"lemma\": 2}' AS last, left(replace(english, 'e', '[redacted]'), 20) AS safe FROM entry WHERE NOT contains(lemma, '`')"))
def model_text(spark, d):
    """Answers with thoughts, fences and several JSON blocks."""
    w = F.col("lemma")
    e = entries(spark, d).where(~w.contains("`"))
    thought = F.concat(F.lit("<think>maybe {"), w, F.lit("}\n</think>\n```text\n"), F.ltrim(w), F.lit(" is kept\n```"))
    blocks = F.concat(F.lit('first {"lemma": 1} then {"lemma": 2} of '), F.lit("it"))
    return e.select("ord", rules.strip_thoughts(thought).alias("shown"), rules.last_json(blocks).alias("last"), rules.redact(F.col("english"), "e", 20).alias("safe"))


@R.add("same_json", "SELECT event_id, value < 50 AS same FROM events WHERE value IS NOT NULL")
def same_json(spark, d):
    e = table(spark, d, "events").where("value is not null")
    a = F.concat(F.lit('{"id":'), "event_id", F.lit(',"k": [1,2]}'))
    b = F.concat(F.lit('{ "k":[1, '), F.when(F.col("value") < 50, "2").otherwise("3"), F.lit('], "id": '), "event_id", F.lit("}"))
    return e.select("event_id", responses.same_json(a, b).alias("same"))
