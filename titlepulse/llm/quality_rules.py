"""Quality rules as a short-circuit cascade.

Each rule has a declared cost per character, word and line.  On a sample, the cost becomes the average for these
documents, and the share of documents that the rule rejects is measured; rules then run in the order of rejections
per cost, and a document that one rejects is not put to the next.  The sample decides the order only: the verdict is
that all rules pass, whatever the order.

DataFrame and SQL functions only; everything about a document is found within its row, so nothing is shuffled.  A
null or empty text has no words and fails.  Repeated rows and ids get equal verdicts.  Runs of words are compared by a
64-bit hash within one document.  An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlepulse.llm.common import SPACES, once, set_aside, words_column

SYMBOLS = "#*$%&|<>"
WINDOW = 5
SAMPLE_DOCS = 2000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents with ``_text, _words`` and the counts that the base rules and the contract are about."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    bare = once(docs, _text=text)
    bare = once(bare, _words=words_column(F.col("_text")))
    runs = ", ".join(f"_words[i + {k}]" for k in range(WINDOW))
    hashed = once(
        bare,
        _runs=F.expr(
            f"if(size(_words) >= {WINDOW}, transform(sequence(0, size(_words) - {WINDOW}), i -> xxhash64({runs})), "
            "cast(array() as array<bigint>))"
        ),
    )
    # Most documents repeat nothing; only the others sort their runs.
    ordered = once(
        hashed,
        _sorted=F.expr(
            "if(size(array_distinct(_runs)) < size(_runs), array_sort(transform(_runs, (h, i) -> struct(h as h, i as i))), null)"
        ),
    )
    repeated = once(
        ordered.drop("_runs"),
        _starts=F.expr(
            "if(_sorted is null, null, array_sort(transform(filter(transform(_sorted, (x, k) -> struct(x.i as i, "
            "(k > 0 and x.h = _sorted[greatest(k - 1, 0)].h) or (k < size(_sorted) - 1 and x.h = _sorted[least(k + 1, size(_sorted) - 1)].h) as twice)), "
            "x -> x.twice), x -> x.i)))"
        ),
    )
    covered = F.expr(
        f"if(_starts is null, 0L, aggregate(_starts, struct(-{WINDOW} as last, 0L as n), "
        f"(a, s) -> struct(s as last, a.n + least({WINDOW}, s - a.last) as n), a -> a.n))"
    )
    lines = F.expr(
        "filter(split(_text, '\\n', -1), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')"
    )
    lined = once(repeated.drop("_sorted"), _lines=lines, n_repeat_words=covered)
    return once(
        lined.drop("_starts"),
        n_words=F.size("_words").cast("long"),
        word_chars=F.length(F.translate("_text", SPACES, "")).cast("long"),
        n_symbols=(F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long"),
        n_lines=F.size("_lines").cast("long"),
        n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    ).drop("_lines")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """``fails``: true for a document to reject.  Costs are in comparable units, for a character, word and line."""

    name: str
    fails: str
    per_char: float = 0.0
    per_word: float = 0.0
    per_line: float = 0.0
    fixed: float = 1.0


RULES = (
    Rule("mean_word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule(
        "shouting",
        "2 * (char_length(_text) - char_length(translate(_text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > word_chars",
        per_char=1.0,
    ),
    Rule("exclamations", "5 * (char_length(_text) - char_length(translate(_text, '!', ''))) > n_words", per_char=1.0),
    Rule("words_without_letters", "5 * size(filter(_words, w -> not w rlike '\\\\p{L}')) > n_words", per_word=8.0),
)

# For texts that still hold personal data: phone and card numbers, amounts and addresses of machines are a few words without
# letters each, and a greeting or heading can be there twice.  A share alone would reject short texts for them, so a
# number is demanded beside it.
MANY = {"words_without_letters": "size(filter(_words, w -> not w rlike '\\\\p{L}')) > 20", "repeated_lines": "n_dup_lines > 3"}
RULES_BEFORE_REDACTION = tuple(replace(rule, fails=f"{MANY[rule.name]} and {rule.fails}") if rule.name in MANY else rule for rule in RULES)


def sampled(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """About ``sample_docs`` rows, by a fraction of each partition: nothing is moved to cut them off."""
    rows = docs.count()
    return docs if rows <= sample_docs else docs.sample(sample_docs / rows, seed=1)


def cascade_order(sample: DataFrame, rules=RULES) -> list[Rule]:
    """The rules by rejections per cost on a sample of measured documents."""
    fails = [F.avg(F.when(F.expr(rule.fails), 1.0).otherwise(0.0)).alias(rule.name) for rule in rules]
    sizes = [F.avg(F.length("_text")).alias("chars"), F.avg("n_words").alias("words"), F.avg("n_lines").alias("lines")]
    row = sample.agg(*sizes, *fails).first()

    def gain(rule: Rule) -> float:
        size = rule.per_char * (row["chars"] or 0) + rule.per_word * (row["words"] or 0) + rule.per_line * (row["lines"] or 0)
        return (row[rule.name] or 0) / (rule.fixed + size)

    return sorted(rules, key=lambda rule: (-gain(rule), rule.name))


def cascade(rules: list[Rule]) -> Column:
    """Name of the first rule that rejects, else null.  A CASE stops at the first branch that holds."""
    chain = F.when(base_failed(), F.lit("base"))
    for rule in rules:
        chain = chain.when(F.coalesce(F.expr(rule.fails), F.lit(False)), F.lit(rule.name))
    return chain


def judge(docs: DataFrame, rules=RULES, name: str = "judged") -> DataFrame:
    """The documents with a struct ``name``: the counts, ``base_failed``, ``failed_rule`` (null: kept) and ``kept``."""
    safe, names, back = set_aside(docs)
    documents = measured(safe, names["text"])
    order = cascade_order(measured(sampled(docs.select("text")), "text"), rules)
    judged = once(documents.withColumn("base_failed", base_failed()), failed_rule=cascade(order))
    judged = judged.withColumn("kept", F.col("failed_rule").isNull())
    return judged.select(*back, F.struct(*COUNTS, "base_failed", "failed_rule", "kept").alias(name))
