"""Text keys, log rules and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.functions.text import choice_key, code_key, digest, text_key
from smelter.operators.joins import enrich
from smelter.operators.lineage import cut_lineage
from smelter.operators.logs import RULES, classify, with_findings
from smelter.operators.tags import API_LABELS, SESSION_LABELS, labels_of, tag
from smelter.plans.catalogue.patterns import NOT_IN_CHOICE, SPACES
from smelter.plans.registry import query
from smelter.sources.readers import table


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query(f"""
SELECT min(doc_id) AS first_doc_id, count(*) AS n_copies
FROM documents GROUP BY lower(trim(regexp_replace(text, '{SPACES}', ' ', 'g'), ' '))
""")
def norm_text_dups(spark: SparkSession, sf: str) -> DataFrame:
    # Grouping on a digest moves 32 bytes per text through the shuffle, and copies
    # are counted before it.
    keyed = table(spark, sf, "documents").select("doc_id", digest(text_key("text")).alias("key"))
    return keyed.groupBy("key").agg(
        F.min("doc_id").alias("first_doc_id"), F.count("*").alias("n_copies")).drop("key")


@query(f"""
SELECT regexp_replace(regexp_replace(trim(props), '["'']', '''', 'g'), '{SPACES}', ' ', 'g') AS code, count(*) AS n
FROM events GROUP BY 1
""")
def norm_code_props(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy(code_key("props").alias("code")).agg(F.count("*").alias("n"))


@query(f"""
WITH guesses AS (
    SELECT c_custkey, c_nationkey, '  (' || lower(c_mktsegment) || ')! ' AS guess FROM customer
),
counts AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL),
answers AS (
    SELECT c_nationkey, c_mktsegment AS correct FROM counts
    QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, c_mktsegment DESC) = 1
)
SELECT c_nationkey, count(*) AS n_guesses,
       count(*) FILTER (WHERE upper(regexp_replace(trim(guess), '{NOT_IN_CHOICE}', '', 'g'))
                            = upper(regexp_replace(trim(correct), '{NOT_IN_CHOICE}', '', 'g'))) AS n_right
FROM guesses JOIN answers USING (c_nationkey) GROUP BY c_nationkey
""")
def choice_match(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_nationkey", "c_mktsegment")
    counts = customers.groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    answers = cut_lineage(counts.groupBy("c_nationkey").agg(
        F.max(F.struct("n", "c_mktsegment"))["c_mktsegment"].alias("correct")))
    guess = F.concat(F.lit("  ("), F.lower("c_mktsegment"), F.lit(")! "))
    guesses = customers.select("c_nationkey", guess.alias("guess"))
    marked = enrich(guesses, answers, "c_nationkey", "inner")
    return marked.groupBy("c_nationkey").agg(
        F.count("*").alias("n_guesses"),
        F.count_if(choice_key("guess") == choice_key("correct")).alias("n_right"))


# Logs written from events: most events give one known problem, some give two, one
# that no rule knows, or none. In SQL and as a Column, both filled in by k.
LOG_KINDS = (
    "AnalysisException: Table or view not found: db.t{k} ;",
    'INFO start\nFile "job.py", line {k}, in run\nAnalysisException: cannot resolve \'col_{k}\' given input',
    "Py4JJavaError: java.lang.ClassNotFoundException: org.x.C{k}\nWARN something deprecated",
    "Traceback: line {k}\nNameError: name 'v{k}' is not defined",
    "TypeError: bad operand {k}\nTypeError: again",
    "AttributeError: 'Frame{k}' object has no attribute 'show{k}'",
    "  IndentationError: unexpected indent {k}\n syntaxerror: also {k}",
    "using spark.sql.shuffle.partitions={k}",
    "\tjava.io.IOException: disk {k} full\nSome Error happened on node {k}\nWARN retry\n  INFO done\n\n",
    "all fine {k}",
)


def _log_text(number: Column, k: Column) -> Column:
    kinds = [F.replace(F.lit(kind), F.lit("{k}"), k) for kind in LOG_KINDS]
    return F.get(F.array(*kinds), F.pmod(number, F.lit(len(LOG_KINDS))).cast("int"))


def event_logs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", _log_text(F.col("event_id"), F.get_json_object("props", "$.k")).alias("log"))


def _log_sql() -> str:
    kinds = ", ".join(_quoted(kind) for kind in LOG_KINDS)
    return f"""
logs AS (
    SELECT event_id, replace(list_extract([{kinds}], CAST(event_id % {len(LOG_KINDS)} AS INTEGER) + 1), '{{k}}',
                             json_extract_string(props, '$.k')) AS log
    FROM events
)"""


def _hits_sql(id_column: str, source: str, text: str) -> str:
    """Every rule as one SELECT; the first rule giving a message keeps it."""
    parts = []
    for index, rule in enumerate(RULES):
        pattern = _quoted("(?i)" + rule.pattern)
        message = _quoted(rule.message)
        for group in range(rule.message.count("{")):
            message = f"replace({message}, '{{{group}}}', regexp_extract({text}, {pattern}, {group + 1}))"
        start = f"strpos({text}, regexp_extract({text}, {pattern}))"
        nearby = f"substr({text}, greatest({start} - 200, 1), {start} + 200 - greatest({start} - 200, 1))"
        parts.append(f"""
    SELECT {id_column}, {index} AS rule, '{rule.severity}' AS severity, {message} AS message,
           try_cast(regexp_extract({nearby}, 'line ([0-9]+)', 1) AS INTEGER) AS line
    FROM {source} WHERE regexp_matches({text}, {pattern})""")
    return f"""
found AS ({" UNION ALL ".join(parts)}),
hits AS (
    SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY {id_column}, message ORDER BY rule) = 1
),
telling AS (
    SELECT {id_column}, list_filter(
               list_transform(string_split({text}, chr(10)), lambda s: trim(s, ' ' || chr(9) || chr(10) || chr(13))),
               lambda s: s <> '' AND NOT regexp_matches(s, '^(WARN|INFO|DEBUG)')) AS lines
    FROM {source} WHERE contains({text}, 'Error') AND {id_column} NOT IN (SELECT {id_column} FROM hits)
),
findings AS (
    SELECT {id_column}, rule, severity, message, line FROM hits
    UNION ALL
    SELECT {id_column}, -1, 'error', left(lines[-1], 200), NULL FROM telling WHERE len(lines) > 0
)"""


@query(f"WITH {_log_sql()}, {_hits_sql('event_id', 'logs', 'log')} SELECT * FROM findings")
def log_rule_hits(spark: SparkSession, sf: str) -> DataFrame:
    return classify(event_logs(spark, sf), "log", longest=200)


@query(f"""
WITH docs AS (
    SELECT doc_id, text || chr(10) || replace(
               list_extract([{", ".join(map(_quoted, LOG_KINDS))}], CAST(doc_id % {len(LOG_KINDS)} AS INTEGER) + 1),
               '{{k}}', CAST(doc_id AS VARCHAR)) AS text
    FROM documents
),
{_hits_sql('doc_id', 'docs', 'text')}
SELECT doc_id, count(message) AS n_findings FROM documents LEFT JOIN findings USING (doc_id) GROUP BY doc_id
""")
def doc_rule_hits(spark: SparkSession, sf: str) -> DataFrame:
    # The documents hold no logs, so each is followed by one.
    logged = F.concat("text", F.lit("\n"), _log_text(F.col("doc_id"), F.col("doc_id").cast("string")))
    docs = table(spark, sf, "documents").select("doc_id", logged.alias("text"))
    return with_findings(docs, "text", "findings").select(
        "doc_id", F.coalesce(F.size("findings"), F.lit(0)).cast("bigint").alias("n_findings"))


# Code written from events, filled in by k.
CODE_KINDS = (
    "spark = SparkSession.builder.appName('a{k}').config('spark.x{k}', 1).config(\"spark.y\", 2).getOrCreate()",
    "df = spark.read.parquet('/t{k}').filter('a > {k}').groupBy('a').count()",
    "q = spark.readStream.load('/t{k}').where('b').withColumn('c{k}', d)",
    "class Job{k}:\n    def run(self):\n        df.join(o, 'k').write.save('/o')",
    "def __init__(self): pass\ndef step{k}(a): return a\ndef last(b): return createDataFrame(b)",
    "print({k})",
)
LABEL_SQL = {
    "CONFIG": r"""list_transform(regexp_extract_all(code, '\.config\([''"]([^''"]+)[''"]', 1),
                  lambda n: '.config(''' || n || ''', ...) — configuration key')""",
    "CLASS": r"""list_transform(regexp_extract_all(code, 'class\s+(\w+)', 1),
                 lambda n: 'class ' || n || ' — define a class')""",
    "FUNCTION": r"""list_transform(list_filter(regexp_extract_all(code, 'def\s+(\w+)', 1), lambda n: n <> '__init__'),
                    lambda n: 'def ' || n || '() — define a function')""",
}


def event_code(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    kinds = [F.replace(F.lit(kind), F.lit("{k}"), k) for kind in CODE_KINDS]
    code = F.get(F.array(*kinds), F.pmod("event_id", F.lit(len(CODE_KINDS))).cast("int"))
    return table(spark, sf, "events").select("event_id", code.alias("code"))


def _fixed_sql(labels, text: str) -> str:
    cases = []
    for parts, label in labels:
        test = " OR ".join(f"contains({text}, {_quoted(p)})" for p in parts)
        cases.append(f"CASE WHEN {test} THEN {_quoted(label)} END")
    return f"list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL)"


def _labels_sql(text: str) -> str:
    named = {k: v.replace("code", text) for k, v in LABEL_SQL.items()}
    named["CONFIG"] = LABEL_SQL["CONFIG"].replace("(code", f"({text}")
    none = "CAST([] AS VARCHAR[])"
    return f"""list_concat(list_concat(list_concat(list_concat(
        {_fixed_sql(SESSION_LABELS, text)},
        CASE WHEN contains({text}, '.config(') THEN {named['CONFIG']} ELSE {none} END),
        {_fixed_sql(API_LABELS, text)}),
        CASE WHEN contains({text}, 'class ') THEN {named['CLASS']} ELSE {none} END),
        CASE WHEN contains({text}, 'def ') AND NOT contains({text}, 'class ')
             THEN {named['FUNCTION']} ELSE {none} END)"""


def _code_sql() -> str:
    kinds = ", ".join(_quoted(kind) for kind in CODE_KINDS)
    return f"""
snippets AS (
    SELECT event_id, replace(list_extract([{kinds}], CAST(event_id % {len(CODE_KINDS)} AS INTEGER) + 1), '{{k}}',
                             json_extract_string(props, '$.k')) AS code
    FROM events
),
labelled AS (SELECT event_id, {_labels_sql('code')} AS labels FROM snippets)"""


@query(f"""
WITH {_code_sql()}
SELECT event_id, CAST(generate_subscripts(labels, 1) - 1 AS INTEGER) AS position, unnest(labels) AS label
FROM labelled
""")
def code_tags(spark: SparkSession, sf: str) -> DataFrame:
    return tag(event_code(spark, sf), "code")


@query(f"""
SELECT doc_id, CAST(len({_labels_sql('text')}) AS INTEGER) AS n_labels FROM documents
""")
def doc_tags(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.size(labels_of(F.col("text"))).alias("n_labels"))
