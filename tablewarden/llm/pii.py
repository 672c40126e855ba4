"""Personal data by fixed forms, and by contexts learned from what they find.

The fixed forms find emails, addresses of machines, cards and phones. A value
behind a word with a mark (``token =``, ``phone:``) stands in three contexts:
that word; the word before it as well; and the word behind the value as well. A
context and a value are the edge of a graph. Values that a fixed form finds, and
long hexadecimal keys, are the seeds. A context is confident when it has enough
known values and they are most of its values, and makes its other values known
in turn. Counts are whole numbers and what is known only grows, so the rounds
end when none adds a value, and the result does not depend on the partitions.

Everything is DataFrame expressions. The marks ``+`` behind a repetition only
keep Java's matcher from recursing or going back; they change no match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import saved

EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "id")

#: Perhaps a word, then a word, a mark, and the value behind it, perhaps in quotes.
CUE = r"""(?<![\p{L}_])(?:[\p{L}_]{2,40}+\x20(?=[\p{L}_]{2,40}+\x20{0,2}[:=\#]))?+[\p{L}_]{2,40}+\x20{0,2}[:=\#]{1,2}+\x20{0,2}["']?+[^\s"'<>,;()\[\]|]++"""
#: The word behind a value.
BEHIND = r"""^["'<>,;()\[\]|.!?]{0,3}+\x20?+([\p{L}_]{2,40}+)"""
#: Matches whose places are added up together.
BLOCK = 128
SECRET = r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]{32,128}$"
LEAST_SEEDS = 3
#: Of ten values of a confident context, those that are known.
CONFIDENT = 6
LEAST_LENGTH = 6


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _found(text: Column, pattern: str, valid=None) -> Column:
    """Array of (hit, start, end, behind) of all matches from the left that are valid, in code points.

    The pieces between the matches give the places; ``behind`` is the piece
    that follows. Places are added up in blocks, and only valid matches are
    gathered, so that a text of very many numbers costs no more than its size.
    """
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), F.slice(gaps, 2, F.size(gaps)).alias("behind"))
    size = lambda p: F.length(p["gap"]) + F.coalesce(F.length(p["hit"]), F.lit(0))
    none = F.array().cast("array<struct<hit:string,start:int,end:int,behind:string>>")

    def of(pairs: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / BLOCK).cast("int"))
        blocks = F.transform(numbers, lambda b: F.slice(pairs, b * BLOCK + 1, BLOCK))
        sizes = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda a, p: a + size(p)))
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        starts = F.aggregate(
            sizes,
            zero,
            lambda s, n: F.struct((s["at"] + n).alias("at"), F.array_append(s["out"], s["at"]).alias("out")),
            lambda s: s["out"],
        )
        return F.flatten(F.transform(F.arrays_zip(blocks.alias("block"), starts.alias("start")), placed))

    def placed(block: Column) -> Column:
        def add(state: Column, pair: Column) -> Column:
            begin = state["at"] + F.length(pair["gap"])
            end = begin + F.coalesce(F.length(pair["hit"]), F.lit(0))
            one = F.struct(pair["hit"].alias("hit"), begin.alias("start"), end.alias("end"), pair["behind"].alias("behind"))
            keep = pair["hit"].isNotNull() if valid is None else pair["hit"].isNotNull() & valid(pair["hit"])
            return F.struct(end.alias("at"), F.when(keep, F.array_append(state["out"], one)).otherwise(state["out"]).alias("out"))

        return F.aggregate(block["block"], F.struct(block["start"].alias("at"), none.alias("out")), add, lambda state: state["out"])

    return _let(pairs, of)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]+", "")


def _luhn(digits: Column) -> Column:
    """Whether the check sum is right: from the right, every second digit counts double."""

    def total(d: Column) -> Column:
        n = F.length(d)
        values = F.transform(
            F.sequence(F.lit(1), n),
            lambda i: F.when((n - i) % 2 == 0, d.substr(i, F.lit(1)).cast("int")).otherwise(
                F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), d.substr(i, F.lit(1)).cast("int") + 1)
            ),
        )
        return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0

    return _let(digits, total)


def _is_ip(hit: Column) -> Column:
    return hit.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2}|)(?:\.|$)){4}$") & ~hit.rlike(r"(?:^|\.)(?:\.|$)")


def _is_card(hit: Column) -> Column:
    n = F.length(_digits(hit))
    return F.when((n >= 14) & (n <= 19), _luhn(_digits(hit))).otherwise(False)


def _is_phone(hit: Column) -> Column:
    return F.length(_digits(hit)).between(10, 15)


def base_spans(text: Column) -> Column:
    """Array of (start, kind, end) of the fixed forms, ``kind`` an index of ``KINDS``, in order."""
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def of(kind: int, pattern: str, needs: str, valid=None) -> Column:
        hits = _found(text, pattern, valid)
        spans = F.transform(hits, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))
        return F.when(text.rlike(needs), spans).otherwise(empty)

    every = F.concat(
        of(0, EMAIL, "@"),
        of(1, IP, r"[0-9]\.[0-9]", _is_ip),
        of(2, CARD, r"[0-9][\x20-]?[0-9]", _is_card),
        of(3, PHONE, r"\+[0-9]", _is_phone),
    )
    return F.array_sort(every)


def cued_values(text: Column) -> Column:
    """Array of (cues, value, start, end) of all values behind a word and a mark, with their contexts."""

    def one(x: Column) -> Column:
        value = F.regexp_extract(x["hit"], r"""[:=\#]++\x20{0,2}["']?+(.*)$""", 1)
        value = F.regexp_replace(value, r"[.!?:*$%&\#]+$", "")
        left = F.regexp_replace(F.lower(F.regexp_extract(x["hit"], r"^[^:=\#]*+[:=\#]++", 0)), r"\x20+(?=[:=\#])", "")
        nearest = F.regexp_extract(left, r"[\p{L}_]++[:=\#]++$", 0)
        right = F.lower(F.regexp_extract(F.coalesce(x["behind"], F.lit("")), BEHIND, 1))
        lead = F.length(F.regexp_extract(x["hit"], r"""^[^:=\#]*+[:=\#]++\x20{0,2}["']?+""", 0))
        start = x["start"] + lead
        cues = F.array_distinct(F.array(nearest, left, F.when(right != "", F.concat(nearest, F.lit(" _ "), right)).otherwise(nearest)))
        return F.struct(
            cues.alias("cues"), F.lower(value).alias("value"), start.alias("start"), (start + F.length(value)).alias("end")
        )

    empty = F.array().cast("array<struct<cues:array<string>,value:string,start:int,end:int>>")
    found = F.filter(F.transform(_found(text, CUE), one), lambda x: x["end"] > x["start"])
    return F.when(text.rlike(r"[:=\#]"), found).otherwise(empty)


def confident_cues(values: DataFrame) -> DataFrame:
    """Contexts of which most values are known, found over the graph of contexts and values.

    ``values`` has ``cue``, ``value`` and ``seed``. Values without a digit, or
    shorter than ``LEAST_LENGTH``, never become known unless they are seeds, but
    count against a context. A context of several words has to be further above
    one half, as there are very many of them.
    """
    like = (F.length("value") >= LEAST_LENGTH) & F.col("value").rlike("[0-9]")
    edges = values.groupBy("cue", "value").agg(F.max("seed").alias("seed"))
    # a value that is a seed anywhere is known everywhere
    seeds = edges.groupBy("value").agg(F.max("seed").alias("known"))
    edges = saved(edges.join(seeds, "value").select("cue", "value", "known", like.alias("like")), "cues")
    known = -1
    while True:
        counts = edges.groupBy("cue").agg(F.count_if("known").alias("support"), F.count("*").alias("n"))
        most = (F.col("support") >= LEAST_SEEDS) & (10 * F.col("support") >= CONFIDENT * F.col("n"))
        # of many contexts of several words some are known by chance: three deviations above one half
        lead = 2 * F.col("support") - F.col("n")
        sure = counts.where(most & (~F.col("cue").contains(" ") | ((lead > 0) & (lead * lead >= 9 * F.col("n"))))).select("cue")
        before, known = known, edges.where("known").count()
        if known == before:
            return sure
        heard = edges.where("like and not known").join(sure, "cue", "left_semi").select("value", F.lit(True).alias("heard")).distinct()
        met = edges.join(heard, "value", "left")
        edges = saved(met.select("cue", "value", (F.col("known") | F.col("heard").isNotNull()).alias("known"), "like"), "known")


def _text_of(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
    return F.concat_ws(",", F.transform(spans, one))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts and digest of the fixed forms, and all spans of every whole text.

    ``spans`` are ``kind:start:end`` in code points, by start, then kind. A span
    of the kind ``id`` comes from a learned cue and never overlaps a fixed form.
    Null and empty texts have none. Repeated rows stay repeated.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = read.select(
        "doc_id", F.xxhash64("text").alias("row"), base_spans(F.col("text")).alias("base"), cued_values(F.col("text")).alias("cued")
    )
    rows = saved(rows, "spans")

    values = rows.where(F.size("cued") > 0).select("doc_id", "row", "base", F.explode("cued").alias("v"))
    touches = F.exists("base", lambda b: (b["start"] < F.col("v.end")) & (F.col("v.start") < b["end"]))
    starts = F.exists("base", lambda b: b["start"] == F.col("v.start"))
    values = values.select(
        "doc_id", "row", "v.*", touches.alias("touches"), (starts | F.col("v.value").rlike(SECRET)).alias("seed")
    )
    by_cue = values.withColumn("cue", F.explode("cues"))
    cues = saved(confident_cues(by_cue.select("cue", "value", "seed")), "confident")
    wanted = ~F.col("touches") & (F.length("value") >= LEAST_LENGTH) & F.col("value").rlike("[0-9]")
    new = by_cue.where(wanted).join(cues, "cue", "left_semi")
    span = F.struct("start", F.lit(4).alias("kind"), "end")
    # what is gathered is bounded by the text it stands in
    more = new.groupBy("doc_id", "row").agg(F.collect_set(span).alias("more"))
    same = F.col("r.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("r.row") == F.col("m.row"))
    joined = rows.drop("cued").alias("r").join(more.alias("m"), same, "left").select("r.doc_id", "r.base", "m.more")

    every = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more")))
    count = lambda kind: F.size(F.filter("base", lambda b: b["kind"] == kind)).cast("long")
    return joined.select(
        "doc_id",
        *[count(k).alias(f"n_{KINDS[k]}") for k in range(4)],
        F.sha2(_text_of(F.col("base")), 256).alias("base_sha256"),
        _text_of(every).alias("spans"),
    )
