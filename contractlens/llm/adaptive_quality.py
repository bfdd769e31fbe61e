"""Quality rules whose cutoffs come from the data.

Four rates describe a document: symbols per word, repeated lines, words inside
repeated five-word windows, and mean word length.  A mergeable quantile sketch
per language, source and rate replaces fixed cutoffs: values are counted in
buckets whose width is at most 1/64 of the value, so sketches merge by adding
counts and every quantile is known to that precision.  Limits are fences around
the middle half of a group; small groups use the merged sketch of their
language, and small languages that of the corpus.  Documents are then joined
with the limits of their group and filtered.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractlens.llm.common import SPACE, materialize

WINDOW = 5
SYMBOLS = "#*$%&|<>"  # fixed value
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

# rate -> (expression over the base counts, scaled to whole numbers; fence factor; least width; lower side too)
RATES: dict[str, tuple[str, int, int, bool]] = {
    "symbol_rate": ("1000 * n_symbols div greatest(n_words, 1)", 4, 100, False),
    "dup_line_rate": ("1000 * n_dup_lines div greatest(n_lines, 1)", 4, 500, False),
    "repeat_rate": ("1000 * n_repeat_words div greatest(n_words, 1)", 4, 100, False),
    "word_length": ("100 * word_chars div greatest(n_words, 1)", 6, 300, True),
}
MIN_ROWS = 200  # a group with fewer documents uses the next larger one
FINE = 7  # leading bits of a value that name its bucket


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words covered by a five-word window that the text holds twice or more."""

    def windows(codes: Column) -> Column:
        last = F.size(codes) - WINDOW
        at = lambda i, k: F.get(codes, i + k)
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)]))

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(rows: Column) -> Column:
            same = lambda i, j: F.get(rows, i)["h"] == F.get(rows, j)["h"]
            twice = lambda r, i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False))
            return F.sort_array(F.transform(F.filter(rows, twice), lambda r: r["i"]))

        def width(starts: Column) -> Column:
            steps = F.transform(
                starts, lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - s, F.lit(WINDOW)))
            )
            return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

        return let(let(placed, positions), width)

    counted = lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0))
    codes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) > WINDOW, let(let(codes, windows), counted)).otherwise(F.lit(0)).cast("long")


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the base counts of the whole text; NULL counts as an empty text."""
    body = F.coalesce(F.col(text), F.lit(""))
    solid = F.regexp_replace(body, f"[{SPACE}]+", "")
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    words = F.filter(F.split(body, f"[{SPACE}]+"), lambda w: w != "")
    line_counts = let(lines, lambda x: F.struct(F.size(x).alias("all"), F.size(F.array_distinct(x)).alias("kinds")))
    word_counts = let(words, lambda w: F.struct(F.size(w).alias("all"), repeated_words(w).alias("repeated")))
    return (
        docs.withColumns({"_lines": line_counts, "_words": word_counts, "_solid": solid})
        .withColumns(
            {
                "n_words": F.col("_words.all").cast("long"),
                "word_chars": F.length("_solid").cast("long"),
                "n_symbols": (F.length("_solid") - F.length(F.translate("_solid", SYMBOLS, ""))).cast("long"),
                "n_dup_lines": (F.col("_lines.all") - F.col("_lines.kinds")).cast("long"),
                "n_repeat_words": F.col("_words.repeated"),
                "n_lines": F.col("_lines.all").cast("long"),
                "base_failed": (F.col("_words.all") < 10) | (100 * F.col("_words.repeated") > 20 * F.col("_words.all")),
            }
        )
        .drop("_lines", "_words", "_solid")
    )


def edge(value: Column) -> Column:
    """Lower edge of the sketch bucket of a whole number >= 0."""
    spare = F.greatest(F.length(F.bin(value)) - FINE, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, spare), spare)


def sketches(counted: DataFrame) -> DataFrame:
    """Bucket counts per language, source and rate, of documents that the base rules pass."""
    rates = F.explode(
        F.array(*[F.struct(F.lit(name).alias("rate"), edge(F.expr(e)).alias("edge")) for name, (e, *_) in RATES.items()])
    )
    return (
        counted.filter(~F.col("base_failed"))
        .select("_lang", "_source", rates.alias("_r"))
        .groupBy("_lang", "_source", "_r.rate", "_r.edge")
        .agg(F.count("*").alias("n"))
    )


def fences(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Sketches merged to the groups ``by`` -> documents and limits of each group and rate."""
    merged = sketch.groupBy(*by, "rate", "edge").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "rate")
    ranked = merged.withColumns(
        {"upto": F.sum("n").over(group.orderBy("edge")), "rows": F.sum("n").over(group)}
    )
    quantile = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("rows") * q, F.col("edge")))
    limits = ranked.groupBy(*by, "rate").agg(
        F.max("rows").alias("rows"), quantile(1).alias("q1"), quantile(2).alias("q2"), quantile(3).alias("q3")
    )
    rule = lambda at: F.create_map(*[x for k, v in RATES.items() for x in (F.lit(k), F.lit(v[at]))])[F.col("rate")]
    reach = F.greatest(rule(1) * (F.col("q3") - F.col("q1")), rule(2))
    return limits.withColumn("upper", F.col("q3") + reach).withColumn(
        "lower", F.when(rule(3), F.col("q1") - reach).otherwise(F.lit(-1))
    )


def group_limits(sketch: DataFrame) -> DataFrame:
    """One row per language and source with the limits of every rate."""
    both = ["_lang", "_source"]
    fine, middle, whole = fences(sketch, both), fences(sketch, both[:1]), fences(sketch, [])
    packed = lambda f, name: f.withColumn(name, F.struct("rows", "lower", "upper"))
    chosen = (
        packed(fine, "_a").select(*both, "rate", "_a")
        .join(packed(middle, "_b").select("_lang", "rate", "_b"), ["_lang", "rate"])
        .join(F.broadcast(packed(whole, "_c").select("rate", "_c")), "rate")  # one row per rate
        .withColumn(
            "_use",
            F.when(F.col("_a.rows") >= MIN_ROWS, F.col("_a")).when(F.col("_b.rows") >= MIN_ROWS, F.col("_b")).otherwise(F.col("_c")),
        )
    )
    return chosen.groupBy(*both).pivot("rate", list(RATES)).agg(F.first("_use"))


def judge(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """Adds base counts, `base_failed` and `kept` to every document.

    NULL language or source is a group of its own; a NULL or empty text has no
    words and fails the base rules; equal rows get equal verdicts; an empty
    table stays empty.  Columns of the same names in the input are replaced.
    The counts are written once, without the text, for the sketches.  Where the
    result keeps the text, verdicts count again while they read it: a second
    pass over the text instead of a copy or a shuffle of it.
    """
    named = lambda c: F.when(F.col(c).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(c)))
    counted = with_counts(docs).withColumns({"_lang": named("lang"), "_source": named("source")})
    narrow = materialize(counted.drop("text"), "counted")
    limits = materialize(group_limits(sketches(narrow)), "limits")
    within = F.lit(True)
    for name, (e, *_) in RATES.items():
        within = within & F.coalesce(F.expr(e).between(F.col(f"_limits.{name}.lower"), F.col(f"_limits.{name}.upper")), F.lit(True))
    keyed = limits.select("_lang", "_source", F.struct(*RATES).alias("_limits"))
    return (
        (counted if keep_text else narrow)
        .join(keyed, ["_lang", "_source"], "left")
        .withColumn("kept", ~F.col("base_failed") & within)
        .drop("_lang", "_source", "_limits")
    )


def oracle() -> str:
    """Counts, sketches, limits and verdicts in SQL."""
    blank = SPACE
    rates = ", ".join(f"{{'rate': '{n}', 'v': {e.replace(' div ', ' // ')}}}" for n, (e, *_) in RATES.items())
    rules = ", ".join(f"('{n}', {factor}, {least}, {lower})" for n, (_, factor, least, lower) in RATES.items())

    def limits(name: str, by: list[str]) -> str:
        keys = "".join(f"{c}, " for c in by)
        part = f"partition by {keys}rate"
        return f"""
{name}_rank as (
  select *, sum(n) over ({part} order by edge) as upto, sum(n) over ({part}) as rows
  from (select {keys}rate, edge, sum(n) as n from sketch group by all)),
{name}_q as (
  select {keys}rate, max(rows) as rows, min(edge) filter (upto * 4 >= rows) as q1, min(edge) filter (upto * 4 >= rows * 3) as q3
  from {name}_rank group by all),
{name} as (
  select q.*, q3 + greatest(factor * (q3 - q1), least) as upper,
    case when two_sided then q1 - greatest(factor * (q3 - q1), least) else -1 end as lower
  from {name}_q q join rules using (rate))"""

    return f"""
with rules(rate, factor, least, two_sided) as (values {rules}),
texts as (
  select row_number() over () as r, doc_id, coalesce('=' || lang, '') as lang, coalesce('=' || source, '') as source, coalesce(text, '') as text
  from documents),
split as (
  select *, regexp_extract_all(text, '[^{blank}]+') as words,
    [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^{blank}]')] as lines from texts),
grams as (select r, i, words[i : i + 4] as gram from (select r, words, unnest(range(1, len(words) - 3)) as i from split)),
again as (select r, unnest(range(i, i + 5)) as place from (select *, count(*) over (partition by r, gram) as n from grams) where n > 1),
covered as (select r, count(distinct place) as n_repeat_words from again group by r),
base as (
  select r, doc_id, lang, source, len(words) as n_words, length(regexp_replace(text, '[{blank}]+', '', 'g')) as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols, len(lines) as n_lines,
    len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words
  from split left join covered using (r)),
counted as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from base),
valued as (select r, lang, source, unnest([{rates}], recursive := true) from counted where not base_failed),
placed as (select *, greatest(length(bin(v)) - {FINE}, 0) as spare from valued),
sketch as (select lang, source, rate, (v >> spare) << spare as edge, count(*) as n from placed group by all),
{limits("fine", ["lang", "source"])}, {limits("middle", ["lang"])}, {limits("whole", [])},
chosen as (
  select f.lang, f.source, f.rate,
    case when f.rows >= {MIN_ROWS} then f.lower when m.rows >= {MIN_ROWS} then m.lower else w.lower end as lower,
    case when f.rows >= {MIN_ROWS} then f.upper when m.rows >= {MIN_ROWS} then m.upper else w.upper end as upper
  from fine f join middle m on m.lang = f.lang and m.rate = f.rate join whole w on w.rate = f.rate),
odd as (
  select distinct r from valued v join chosen c on c.lang = v.lang and c.source = v.source and c.rate = v.rate
  where v.v not between c.lower and c.upper)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and odd.r is null as kept
from counted left join odd using (r)"""
