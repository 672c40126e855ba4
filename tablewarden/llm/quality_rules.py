"""Quality rules: a table of thresholds compiled into one Spark projection."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for was on with as be by this are at from "
    "de la le les des et en un une du que qui pour dans au par pas sur "
    "der die das und den von zu mit sich auf ist im dem nicht ein eine "
    "el los las y se del por con para no es al"
).split()


@dataclass(frozen=True)
class Rule:
    """A ratio of two counts, and the range in which a text is kept."""

    name: str
    part: str
    whole: str
    least: float = 0.0
    most: float = float("inf")


RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2.5, 12.0),
    Rule("symbols_per_word", "n_symbols", "n_words", most=0.1),
    Rule("stop_words", "n_stop_words", "n_words", least=0.04),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", most=0.5),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _long(c: Column) -> Column:
    return c.cast("long")


def repeated_words(words: Column) -> Column:
    """How many words stand in a window of three that the text holds twice or more.

    Windows are compared by 64-bit hashes of the three words. Only where some
    window repeats are they sorted, with their places, and equal neighbours
    taken.
    """

    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(w) - 2),
            lambda i: F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)),
        )

    def covered(w: Column) -> Column:
        placed = F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            n = F.size(s)
            h = lambda j: F.get(s, j)["h"]
            same = F.filter(s, lambda x, j: ((j > 0) & (x["h"] == h(j - 1))) | ((j < n - 1) & (x["h"] == h(j + 1))))
            return F.flatten(F.transform(same, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))

        return F.size(F.array_distinct(let(placed, places)))

    counted = let(windows(words), lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(0))
    return F.when(F.size(words) < 4, 0).otherwise(counted)


def _lower_word(w: Column) -> Column:
    """Lower case, without marks at the ends."""
    return F.lower(F.btrim(w, F.lit(".,;:!?\"'()")))


def counts(text: Column) -> Column:
    """A struct of all counts that the rules and the base need."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    stop_words = F.array(*[F.lit(w) for w in STOP_WORDS])

    def of(w: Column) -> Column:
        return let(
            lines,
            lambda ls: F.struct(
                _long(F.size(w)).alias("n_words"),
                _long(F.length(F.regexp_replace(text, SPACE, ""))).alias("word_chars"),
                _long(F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", ""))).alias("n_symbols"),
                _long(F.size(ls) - F.size(F.array_distinct(ls))).alias("n_dup_lines"),
                _long(F.size(ls)).alias("n_lines"),
                _long(repeated_words(w)).alias("n_repeat_words"),
                _long(F.size(F.filter(w, lambda x: F.array_contains(stop_words, _lower_word(x))))).alias("n_stop_words"),
            ),
        )

    return let(words, of)


def compiled(rules: tuple[Rule, ...], count: Column) -> Column:
    """True where every ratio is in its range; an empty whole counts as one."""
    out = F.lit(True)
    for r in rules:
        whole = F.greatest(count[r.whole], F.lit(1))
        out = out & (count[r.part] >= F.lit(r.least) * whole)
        if r.most != float("inf"):
            out = out & (count[r.part] <= F.lit(r.most) * whole)
    return out


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id``, the counts of every whole text, ``base_failed`` and ``kept``.

    A null or empty text has no words and fails. Repeated rows stay repeated;
    other columns are left out.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), counts(text).alias("c"))
    c = F.col("c")
    failed = (c["n_words"] < LEAST_WORDS) | (100 * c["n_repeat_words"] > MOST_REPEATED_PERCENT * c["n_words"])
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return counted.select(
        "doc_id",
        *[c[n].alias(n) for n in names],
        failed.alias("base_failed"),
        (~failed & compiled(rules, c)).alias("kept"),
        c["n_stop_words"].alias("n_stop_words"),
        c["n_lines"].alias("n_lines"),
    )


def oracle() -> str:
    """DuckDB SQL for the rows of ``apply_rules`` with the rules as they stand."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    tests = []
    for r in RULES:
        whole = f"greatest({r.whole}, 1)"
        tests.append(f"{r.part} >= CAST({r.least} AS DOUBLE) * {whole}")
        if r.most != float("inf"):
            tests.append(f"{r.part} <= CAST({r.most} AS DOUBLE) * {whole}")
    return rf"""
    WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    split_up AS (
        SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
               list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
        FROM texts),
    tri AS (
        SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t
        FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM split_up)),
    often AS (SELECT r, i FROM tri QUALIFY count(*) OVER (PARTITION BY r, t) > 1),
    covered AS (
        SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM often, (VALUES (0), (1), (2)) AS s(k) GROUP BY r),
    counted AS (
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
               CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
               CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
               CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
               CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
               CAST(len(list_filter(w, lambda x: lower(trim(x, '.,;:!?"''()')) IN ({stop}))) AS BIGINT) AS n_stop_words,
               CAST(len(ls) AS BIGINT) AS n_lines
        FROM split_up LEFT JOIN covered USING (r)),
    based AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed FROM counted)
    SELECT *, NOT base_failed AND {" AND ".join(tests)} AS kept FROM based"""
