"""Classifying log text by rules: which known problems does a log show?"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.functions.text import strip


@dataclass(frozen=True)
class Rule:
    pattern: str
    severity: str
    message: str  # {0}, {1}: the pattern's groups
    literal: str  # lower-case text that every match contains, for a quick test first


# Patterns, severities and messages of the known problems.
RULES = (
    Rule(r"AnalysisException.*Table or view not found: (\S+)", "error",
         "Table '{0}' doesn't exist. Check the table name and catalog.",
         "table or view not found: "),
    Rule(r"AnalysisException.*cannot resolve '(\w+)'", "error",
         "Column '{0}' not found. Check your column names with df.printSchema().",
         "cannot resolve '"),
    Rule(r"Py4JJavaError.*ClassNotFoundException: (\S+)", "error",
         "Missing dependency: {0}. The JAR may not be on the classpath.",
         "classnotfoundexception: "),
    Rule(r"NameError: name '(\w+)' is not defined", "error",
         "Variable '{0}' is not defined. Did you forget to import or create it?",
         "nameerror: name '"),
    Rule(r"TypeError: (.+)", "error", "Type error: {0}",
         "typeerror: "),
    Rule(r"AttributeError: '(\w+)' object has no attribute '(\w+)'", "error",
         "'{0}' doesn't have attribute '{1}'. Check the API docs.",
         "' object has no attribute '"),
    Rule(r"IndentationError: (.+)", "error", "Indentation error: {0}. Check your whitespace.",
         "indentationerror: "),
    Rule(r"SyntaxError: (.+)", "error", "Syntax error: {0}",
         "syntaxerror: "),
    Rule(r"spark\.sql\.shuffle\.partitions", "info",
         "Tip: shuffle partitions defaults to 200. For small data, set it lower.",
         "spark.sql.shuffle.partitions"),
    Rule(r"WARN.*deprecated", "info",
         "Deprecation warning detected — the code still works but consider updating.",
         "deprecated"),
)
# How far around a match a line number is looked for unless the caller says otherwise, the
# starts of mere log level lines, and what a line number looks like.
NEARBY = 200
LEVEL_PREFIXES = ("WARN", "INFO", "DEBUG")
LINE_NUMBER = r"line (\d+)"

# Letters that equal an ASCII letter when case is ignored, though their
# lower case is not that letter.
ODD_LETTERS = "ſıİK"

# Case-insensitive, Unicode classes, and only \n ends a line for '.'.
FLAGS = "(?idU)"


def _hit(text: Column, index: int, rule: Rule, nearby: int | None) -> Column:
    """A finding for the rule's first match, which starts at ``_starts[index]``, else NULL."""
    start = F.col("_starts")[index]
    message: Column = F.lit(rule.message)
    for group in range(rule.message.count("{")):
        found = F.regexp_extract(text, FLAGS + rule.pattern, group + 1)
        message = F.replace(message, F.lit(f"{{{group}}}"), found)
    around = text
    if nearby is not None:
        first = F.greatest(start - nearby, F.lit(1))
        around = F.substring(text, first, start + nearby - first)
    line = F.regexp_extract(around, LINE_NUMBER, 1).try_cast("int")
    finding = F.struct(
        F.lit(index).alias("rule"), F.lit(rule.severity).alias("severity"),
        message.alias("message"), line.alias("line"),
    )
    return F.when(start <= F.length(text), finding)


def _last_error(text: Column, longest: int | None) -> Column:
    """The last line that is not blank and not a mere log level line."""
    lines = F.transform(F.split(strip(text), "\n"), strip)
    telling = F.filter(
        lines,
        lambda s: (s != "") & ~F.array_contains(
            F.transform(F.array(*map(F.lit, LEVEL_PREFIXES)), lambda p: F.startswith(s, p)), True),
    )
    last = F.try_element_at(telling, F.lit(-1))
    return last if longest is None else F.left(last, F.lit(longest))


def with_findings(df: DataFrame, text: str, name: str, rules: tuple[Rule, ...] = RULES,
                  nearby: int | None = NEARBY, longest: int | None = None) -> DataFrame:
    """``df`` with the findings of each log as an array of rule, severity, message and line.

    A log that matches no rule but mentions an error gives its last telling line, whole unless
    ``longest`` cuts it. The line number of a finding is the first one at most ``nearby``
    characters around its match; None looks at the whole log. The rules are part of the
    expression, so this is a map over the logs: no join, no shuffle.
    """
    log = F.col(text)
    # Each step is a column of its own, so that the next one reads it instead of
    # working it out again for every element.
    # Searching plain text is much faster than matching, so the pattern is tried only
    # where its literal part is there, or cannot be ruled out for odd letters.
    odd = F.lit(False)
    for letter in ODD_LETTERS:
        odd = odd | log.contains(letter)
    searched = df.withColumns({"_lower": F.lower(log), "_odd": odd, "_beyond": F.length(log) + 1})
    # What lies before the first match, counted in characters; without a match that is the whole log.
    starts = F.array(*[
        F.when(F.col("_odd") | F.col("_lower").contains(rule.literal),
               F.length(F.element_at(F.split(log, FLAGS + rule.pattern, 2), 1)) + 1).otherwise(F.col("_beyond"))
        for rule in rules
    ])
    hits = searched.withColumn("_starts", starts).withColumn(
        "_all", F.array_compact(F.array(*[_hit(log, i, r, nearby) for i, r in enumerate(rules)])))
    unique = F.filter(
        "_all", lambda hit, i: ~F.exists(F.slice("_all", F.lit(1), i), lambda h: h["message"] == hit["message"]))
    last = F.when((F.size("_all") == 0) & log.contains("Error"), _last_error(log, longest))
    listed = hits.select(*df.columns, unique.alias("_unique"), last.alias("_last"))
    fallback = F.array(F.struct(F.lit(-1).alias("rule"), F.lit("error").alias("severity"),
                                F.col("_last").alias("message"), F.lit(None).cast("int").alias("line")))
    findings = F.when(F.col("_last").isNotNull(), fallback).otherwise(F.col("_unique"))
    return listed.select(*df.columns, findings.alias(name))


def classify(df: DataFrame, text: str, rules: tuple[Rule, ...] = RULES, nearby: int | None = NEARBY,
             longest: int | None = None) -> DataFrame:
    """One row per (log, message): columns of ``df`` but the text, plus the finding; see ``with_findings``."""
    kept = [c for c in df.columns if c != text]
    # A plain explode makes Spark filter on the number of findings first, with the whole expression written out once for
    # every use of a step: that takes far longer than the findings. The outer one adds no such filter.
    found = with_findings(df, text, "_findings", rules, nearby, longest).select(
        *kept, F.explode_outer("_findings").alias("_finding"))
    return found.filter(F.col("_finding").isNotNull()).select(*kept, "_finding.*")
