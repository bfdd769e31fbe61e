r"""Personal data, and the words that give it away.

Patterns find the protected entities: mail addresses, network addresses, card
and phone numbers.  Corpus co-occurrence then estimates what a word tells about
an entity.  With N words in the corpus, n(t) occurrences of word t, n(e) word
places within reach of a mention of entity e, and n(e,t) of them held by t,

    information of e        IC  = log2(N / n(e))
    what t tells about e    PMI = log2(n(e,t) * N / (n(e) * n(t)))

t discloses e where PMI reaches `ALPHA` of IC and t was seen beside e in
`CONTEXTS` different surroundings, so that copies of one passage prove nothing.
A disclosing word is masked wherever it stands in a text that holds it near the
entity.  It is generalised to its first letters if that class of words discloses
less than the threshold, and removed otherwise.

A text is split at the matches of a kind; positions are running sums of the
lengths, taken blockwise so that many matches in one text stay cheap.  Pairs of
entity and word are only formed inside the reach of a mention, so their number
grows with the mentions, not with the square of a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlens.llm.adaptive_quality import let
from contractlens.llm.common import materialize

ALPHA = 0.95  # share of an entity's information that a word may not reach
CONTEXTS = 3  # different surroundings in which entity and word were seen together
WORDS = 8  # words on either side of a mention
REACH = 160  # code points on either side that are searched for them
PREFIX = 3  # code points of the class a word is generalised to
ROUNDING = 1e-9

# The kinds in their order, and their patterns.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# The same matches without backtracking: starts inside a run, which end as its first start did, are not tried.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDED = {"email": "@", "ip": ".", "phone": "+"}  # texts without it have no match
WORD = r"[\p{L}\p{N}]+"
TOKEN = f"{PATTERNS['email']}|{WORD}"  # what a mail address is made of counts as no word
BLOCK = 64


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def ends(widths: Column) -> Column:
    """Running sums of an array: sums of the blocks before, then inside the block; no step copies the array."""
    block = lambda i: F.floor(i / BLOCK).cast("int")
    every = F.sequence(F.lit(0), block(F.size(widths)))
    within = F.sequence(F.lit(0), F.lit(BLOCK - 1))
    cut = F.transform(every, lambda b: F.transform(within, lambda k: F.coalesce(F.get(widths, b * BLOCK + k), F.lit(0))))

    def inside(blocks: Column) -> Column:
        def sums(each: Column) -> Column:
            before = F.transform(each, lambda _, b: total(F.slice(each, F.lit(1), b)))
            part = lambda i: total(F.slice(F.get(blocks, block(i)), F.lit(1), i % BLOCK + 1))
            return let(before, lambda base: F.transform(widths, lambda _, i: F.get(base, block(i)) + part(i)))

        return let(F.transform(blocks, total), sums)

    return let(cut, inside)


def luhn(digits: Column) -> Column:
    doubled = lambda i: F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int") * (2 - i % 2)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + doubled(i) - F.when(doubled(i) > 9, 9).otherwise(0)) % 10 == 0


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        bare = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(F.split(value, r"\."), lambda p: (F.length(bare(p)) < 3) | ((F.length(bare(p)) == 3) & (bare(p) <= "255")))
    if kind == "card":
        return let(digits_of(value), lambda d: F.when(F.length(d).between(16, 19), luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(digits_of(value)).between(8, 15)
    return F.lit(True)


def entity(kind: str, value: Column) -> Column:
    bare = {"email": F.lower(value), "ip": value}.get(kind, digits_of(value))
    return F.concat(F.lit(f"{kind}:"), bare)


def words_of(text: Column) -> Column:
    return F.filter(F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0)), lambda w: ~F.contains(w, F.lit("@")))


def beside(before: Column, after: Column) -> Column:
    """Words within reach of a mention; those that the reach cuts are left out."""
    # A word that the reach may have cut stands first before, and last after the mention.
    left = let(words_of(F.right(before, F.lit(REACH))), lambda w: F.when(F.length(before) > REACH, F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0)))).otherwise(w))
    right = let(words_of(F.left(after, F.lit(REACH))), lambda w: F.when(F.length(after) > REACH, F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0)))).otherwise(w))
    nearest = let(left, lambda w: F.slice(w, F.greatest(F.size(w) - WORDS, F.lit(0)) + 1, F.lit(WORDS)))
    return F.concat(nearest, F.slice(right, F.lit(1), F.lit(WORDS)))


def found(text: Column, kind: str, context: bool) -> Column:
    """Valid matches of a kind: start, end, and with ``context`` entity and words beside; NULL without any."""

    def placed(gaps: Column, values: Column) -> Column:
        widths = F.zip_with(F.slice(gaps, F.lit(1), F.size(values)), values, lambda g, v: F.length(g) + F.length(v))

        def spans(end: Column) -> Column:
            def row(value: Column, i: Column) -> Column:
                fields = [F.lit(kind).alias("kind"), (F.get(end, i) - F.length(value)).alias("start"), F.get(end, i).alias("end")]
                if context:
                    fields += [entity(kind, value).alias("entity"), beside(F.get(gaps, i), F.get(gaps, i + 1)).alias("words")]
                return F.when(valid(kind, value), F.struct(*fields))

            return F.filter(F.transform(values, row), lambda s: s.isNotNull())

        return let(let(widths, ends), spans)

    pattern = PATTERNS[kind]
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    some = let(values, lambda v: F.when(F.size(v) > 0, let(F.split(text, pattern, -1), lambda g: placed(g, v))))
    return F.when(F.contains(text, F.lit(NEEDED[kind])), some) if kind in NEEDED else some


def all_found(text: Column, context: bool) -> dict[str, Column]:
    more = ",entity:string,words:array<string>" if context else ""
    empty = F.array().cast(f"array<struct<kind:string,start:int,end:int{more}>>")
    return {f"_{kind}": F.coalesce(found(text, kind, context), empty) for kind in PLAIN}


def mentions(docs: DataFrame, text: str) -> DataFrame:
    """(text_key, entity, words) of every mention, in texts that hold any."""
    body = docs.select(F.col(text).alias("_text"))
    shown = body.withColumns(all_found(F.col("_text"), True))
    shown = shown.withColumn("_all", F.concat(*[f"_{k}" for k in PLAIN])).filter(F.size("_all") > 0)
    keyed = shown.select(F.md5(F.col("_text").cast("binary")).alias("text_key"), "_all")  # once per text, not per mention
    return keyed.select("text_key", F.explode("_all").alias("m")).select("text_key", "m.entity", "m.words")


def disclosing(docs: DataFrame, seen: DataFrame, text: str) -> DataFrame:
    """(entity, term, mask): the words that disclose an entity, and what takes their place."""
    pairs = (
        seen.select("entity", F.xxhash64("words").alias("context"), F.explode("words").alias("term"))
        .groupBy("entity", "term", "context")
        .agg(F.count("*").alias("n"))
        .groupBy("entity", "term")
        .agg(F.sum("n").alias("n_pair"), F.count("*").alias("contexts"))
    )
    pairs = materialize(pairs, "pairs")
    around = pairs.groupBy("entity").agg(F.sum("n_pair").alias("n_entity"))
    usual = pairs.filter(F.col("contexts") >= CONTEXTS)
    if usual.isEmpty():  # no word was seen beside an entity often enough: nothing to estimate
        return docs.sparkSession.createDataFrame([], "entity string, term string, mask string")
    terms = docs.select(F.explode(words_of(F.col(text))).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    terms = materialize(terms, "terms")
    corpus = terms.agg(F.sum("n_term")).scalar()
    first = F.left("term", F.lit(PREFIX))
    classes = terms.groupBy(first.alias("_class")).agg(F.sum("n_term").alias("n_class"))

    def discloses(pair: str, single: str) -> Column:
        both = F.least(pair, single)  # reaches of neighbouring mentions may overlap
        told = F.log2(both * corpus.cast("double") / (F.col("n_entity") * F.col(single).cast("double")))
        information = F.log2(corpus.cast("double") / F.col("n_entity"))
        return (information > 0) & (told >= ALPHA * information - ROUNDING)

    known = usual.join(terms, "term").join(around, "entity").filter(discloses("n_pair", "n_term"))
    known = known.select("entity", "term", "n_entity", first.alias("_class"))
    within = pairs.withColumn("_class", first).join(known.select("entity", "_class").distinct(), ["entity", "_class"], "left_semi")
    within = within.groupBy("entity", "_class").agg(F.sum("n_pair").alias("n_within"))
    wide = known.join(within, ["entity", "_class"]).join(classes, "_class")
    general = (F.length("term") > PREFIX) & ~discloses("n_within", "n_class")
    return wide.select("entity", "term", F.when(general, F.concat("_class", F.lit("*"))).otherwise(F.lit("")).alias("mask"))


def to_mask(docs: DataFrame, text: str) -> DataFrame:
    """(text_key, masks): disclosing words of every text that holds one near its entity, with their masks.

    A word that discloses several entities is generalised only if none of them forbids it.
    """
    seen = materialize(mentions(docs, text), "mentions")
    known = materialize(disclosing(docs, seen, text), "disclosing")
    here = seen.select("text_key", "entity", F.explode("words").alias("term")).distinct()
    masks = here.join(known, ["entity", "term"]).groupBy("text_key", "term").agg(F.min("mask").alias("mask"))
    return masks.groupBy("text_key").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("term", "mask")))).alias("_masks"))


def masked_words(text: Column, masks: Column) -> Column:
    """Places of the words that have a mask; NULL without masks."""

    def placed(gaps: Column, values: Column) -> Column:
        widths = F.zip_with(F.slice(gaps, F.lit(1), F.size(values)), values, lambda g, v: F.length(g) + F.length(v))
        rows = lambda end: F.transform(values, lambda v, i: F.when(
            F.map_contains_key(masks, F.lower(v)), F.struct(F.lit("term").alias("kind"), (F.get(end, i) - F.length(v)).alias("start"), F.get(end, i).alias("end"))))
        return F.filter(let(let(widths, ends), rows), lambda s: s.isNotNull())

    values = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    return F.when(masks.isNotNull(), let(F.split(text, TOKEN, -1), lambda g: let(values, lambda v: placed(g, v))))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def cleaned(text: Column, masks: Column) -> Column:
    """The text with entities replaced by their kind, kind after kind, and disclosing words by their mask."""

    def replaced(body: Column, pattern: str, new) -> Column:
        def merge(gaps: Column) -> Column:
            values = F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
            pieces = let(values, lambda v: F.transform(gaps, lambda g, i: F.concat(g, F.when(i < F.size(v), new(F.get(v, i))).otherwise(F.lit("")))))
            return F.array_join(pieces, "")

        return let(F.split(body, pattern, -1), merge)

    def without(kind: str, body: Column) -> Column:
        shown = lambda v: F.when(valid(kind, v), F.lit(f"<{kind.upper()}>")).otherwise(v)
        return let(body, lambda b: replaced(b, PATTERNS[kind], shown))

    for kind in PATTERNS:
        text = without(kind, text)
    by_word = let(text, lambda body: replaced(body, TOKEN, lambda v: F.coalesce(F.get(F.array(masks[F.lower(v)]), F.lit(0)), v)))
    return let(text, lambda body: F.when(masks.isNull(), body).otherwise(by_word))


def sanitise(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """The documents with n_email, n_ip, n_card, n_phone, base (spans of the patterns), spans (all) and clean_text.

    Spans are kind:start:end in code points, by kind (email, ip, card, phone, term) and start.
    NULL and empty texts hold nothing; texts of any length are searched whole, in time that
    grows with their length; copies of a text get equal spans, and their mentions count as often as
    they occur but as one surrounding; an empty table stays empty.  Columns of the same names in the
    input are replaced.  Entities compare without case (mail) or by their digits
    (card, phone).  Texts are matched to their masks by their MD5, ids are not used.
    """
    body = docs.withColumn("_body", F.coalesce(F.col(text), F.lit("")))
    masks = materialize(to_mask(body.select("_body"), "_body"), "masks")
    keyed = body.withColumn("text_key", F.md5(F.col("_body").cast("binary"))).join(masks, "text_key", "left")
    placed = keyed.withColumns(all_found(F.col("_body"), False)).withColumn("_term", masked_words(F.col("_body"), F.col("_masks")))
    base = F.concat(*[f"_{k}" for k in PLAIN])
    every = F.concat(base, F.coalesce("_term", F.array().cast("array<struct<kind:string,start:int,end:int>>")))
    made = {f"n_{k}": F.size(f"_{k}").cast("long") for k in PLAIN}
    made |= {"base": joined(base), "spans": joined(every), "clean_text": cleaned(F.col("_body"), F.col("_masks"))}
    kept = [c for c in docs.columns if c not in made]
    return placed.select(*[F.col(c) for c in kept], *[v.alias(k) for k, v in made.items()])


def oracle() -> str:
    """Matches, co-occurrence, thresholds and spans in SQL."""
    checks = {
        "email": "true",
        "ip": "len([p for p in string_split(m, '.') if length(ltrim(p, '0')) > 3 or (length(ltrim(p, '0')) = 3 and ltrim(p, '0') > '255')]) = 0",
        "card": """length(d) between 16 and 19 and list_sum([
          case when (length(d) - i) % 2 = 0 then cast(substr(d, i, 1) as int)
            else 2 * cast(substr(d, i, 1) as int) - case when cast(substr(d, i, 1) as int) > 4 then 9 else 0 end end
          for i in range(1, length(d) + 1)]) % 10 = 0""",
        "phone": "length(d) between 8 and 15",
    }
    names = {"email": "lower(m)", "ip": "m"}
    token = f"{PLAIN['email']}|{WORD}"
    words = lambda t: f"[x for x in regexp_extract_all(lower({t}), '{token}') if not contains(x, '@')]"
    parts = " union all ".join(
        f"""
  select r, '{k}' as kind, {n} as k, place - length(m) as s, place as e, '{k}:' || {names.get(k, 'd')} as entity, gap, next_gap from (
    select *, regexp_replace(m, '[^0-9]', '', 'g') as d, lead(gap) over (partition by r order by i) as next_gap,
      sum(length(gap) + coalesce(length(m), 0)) over (partition by r order by i) as place
    from (select r, unnest(gaps) as gap, unnest(ms) as m, unnest(range(len(gaps))) as i
      from (select r, string_split_regex(text, '{p}') as gaps, regexp_extract_all(text, '{p}') as ms from docs) where len(ms) > 0))
  where m is not null and {checks[k]}"""
        for n, (k, p) in enumerate(PLAIN.items())
    )
    return f"""
with docs as materialized (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
base as materialized ({parts}),
reach as (
  select *, {words(f'right(gap, {REACH})')} as lw, {words(f'left(next_gap, {REACH})')} as rw from base),
cut as (
  select *, case when length(gap) > {REACH} then lw[2:] else lw end as l, case when length(next_gap) > {REACH} then rw[1:greatest(len(rw) - 1, 0)] else rw end as w from reach),
near as (select r, entity, list_concat(l[greatest(len(l) - {WORDS} + 1, 1):], w[1:{WORDS}]) as words from cut),
pairs as materialized (
  select entity, term, sum(n) as n_pair, count(*) as contexts
  from (select entity, words, term, count(*) as n from (select entity, words, unnest(words) as term from near) group by all) group by all),
around as (select entity, sum(n_pair) as n_entity from pairs group by all),
terms as materialized (select term, count(*) as n_term from (select unnest({words('text')}) as term from docs) group by all),
corpus as (select cast(sum(n_term) as double) as n from terms),
disclosing as (
  select entity, term from pairs join terms using (term) join around using (entity), corpus
  where contexts >= {CONTEXTS} and n > n_entity and log2(least(n_pair, n_term) * n / (n_entity * cast(n_term as double))) >= {ALPHA} * log2(n / n_entity) - {ROUNDING}),
masked as (select distinct r, term from (select r, entity, unnest(words) as term from near) join disclosing using (entity, term)),
tokens as (
  select r, lower(m) as term, place - length(m) as s, place as e from (
    select *, sum(length(gap) + coalesce(length(m), 0)) over (partition by r order by i) as place
    from (select r, unnest(string_split_regex(text, '{token}')) as gap, unnest(regexp_extract_all(text, '{token}')) as m,
        unnest(range(len(string_split_regex(text, '{token}')))) as i
      from docs where r in (select r from masked))) where m is not null),
spans as (
  select r, k, kind, s, e from base union all
  select r, 4, 'term', s, e from tokens join masked using (r, term)),
texts as (
  select r, string_agg(kind || ':' || cast(s as bigint) || ':' || cast(e as bigint), ',' order by k, s) filter (k < 4) as base,
    string_agg(kind || ':' || cast(s as bigint) || ':' || cast(e as bigint), ',' order by k, s) as spans,
    {", ".join(f"count(*) filter (k = {n}) as n_{k}" for n, k in enumerate(PLAIN))}
  from spans group by r)
select doc_id, {", ".join(f"coalesce(n_{k}, 0) as n_{k}" for k in PLAIN)}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from docs left join texts using (r)"""
