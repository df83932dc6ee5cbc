"""Personal data: patterns for the data itself, and co-occurrence for the terms that give it away.

Built-in functions only.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers
found by pattern and checked (parts up to 255, Luhn, number of digits).

Every distinct value found is a protected entity ``e``, and every word outside
the spans a term ``t``.  Documents are counted whole: ``n(e)`` hold the entity,
``n(t)`` the term and ``n(t, e)`` both, however far apart.  With ``N``
documents, ``IC(e) = log2(N / n(e))`` is the information that the entity
carries and ``PMI(t, e) = log2(N * n(t, e) / (n(t) * n(e)))`` what the term
gives away of it.  Where ``PMI / IC`` reaches ``GENERALISE`` every occurrence
of the term, in documents without the entity too, becomes a span of kind
``term``; from ``REMOVE`` on ``sanitised`` drops it, below that it puts a
general word.  A term needs ``SUPPORT`` different texts with the entity: one
text and its exact copies are no evidence, as each of its own words would give
away all.

Since ``n(t, e) <= n(e)``, a term can reach the threshold ``g`` only if
``n(t) <= N ** (1 - g) * n(e) ** g``: pairs beyond that, and of entities or
terms without enough support, are left out before they are counted, which
changes no result.

Patterns run in time proportional to the text: repeats are possessive, and a
search begins only where a run of its characters begins (or the last match
ended), which finds the same leftmost matches.

Defined results: a null text is empty and has no spans.  Rows that repeat an id
and its text get the same spans.  Overlapping spans of different kinds are all
listed.  An empty table gives an empty result.  Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.common import col, settle, spread_join, text_of

#: kinds in their order, with the pattern of each
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:\G|(?<![0-9])(?<![0-9][\x20-]))[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
WORD = r"[\p{L}][\p{L}\p{N}_]+"
BLOCK = 64
GENERALISE = 0.8
REMOVE = 0.95
SUPPORT = 3
SPAN = "array<struct<start:int,after:int,value:string>>"


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(steps: Column) -> Column:
    """Sums of an array of numbers up to each place, block by block: an array that grows step by step costs its square."""
    last = lambda a: F.coalesce(F.get(a, F.size(a) - 1), F.lit(0))
    summed = lambda a: F.aggregate(
        a, F.array().cast("array<int>"), lambda acc, x: F.concat(acc, F.array(last(acc) + x))
    )
    starts = lambda own: F.sequence(F.lit(1), F.greatest(F.size(own), F.lit(1)), F.lit(BLOCK))
    inner = lambda own: F.transform(starts(own), lambda k: summed(F.slice(own, k, F.lit(BLOCK))))
    before = lambda own: F.concat(F.array(F.lit(0)), summed(F.transform(own, last)))
    moved = lambda own: F.flatten(
        F.zip_with(own, F.slice(before(own), F.lit(1), F.size(own)), lambda x, at: F.transform(x, lambda y: y + at))
    )
    return bound(bound(steps, inner), moved)


def matches(text: Column, pattern: str, found: Column | None = None) -> Column:
    """Leftmost non-overlapping matches with their places in code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)) if found is None else found
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    steps = F.zip_with(gaps, found, lambda g, v: F.char_length(g) + F.char_length(v))
    spans = F.zip_with(
        found,
        running(steps),
        lambda v, after: F.struct((after - F.char_length(v)).alias("start"), after.alias("after"), v.alias("value")),
    )
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast(SPAN))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """True if the check digit of a number (from the right, every second digit doubled) is right."""
    own = F.reverse(F.split(digits(value), ""))
    own = F.filter(own, lambda c: c != "")

    def weigh(c: Column, k: Column) -> Column:
        d = c.cast("int")
        twice = d * 2
        return F.when(k % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(own, weigh), F.lit(0), lambda a, b: a + b) % 10 == 0


CHECKS = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: v.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$"),
    "card": lambda v: F.length(digits(v)).between(14, 19) & luhn(v),
    "phone": lambda v: F.length(digits(v)).between(10, 15),
}


def base_spans(df: DataFrame, id_col: str, text_col: str, *others: str) -> DataFrame:
    """id, text_key, the checked spans (start, rank, kind, after, value) in their order, and the text with blanks for them."""
    rows = df.select(col(id_col).alias("id"), text_of(text_col).alias("text"), *others)
    hint = {"email": "@", "ip": ".", "card": "", "phone": "+"}
    rows = rows.select(
        "id",
        "text",
        *others,
        *[
            F.when(
                F.contains("text", F.lit(hint[k])), F.regexp_extract_all("text", F.lit(p), F.lit(0))
            ).otherwise(F.array().cast("array<string>")).alias(f"found_{k}")
            for k, p in KINDS.items()
        ],
    )
    text = F.col("text")

    def spans(rank: int, kind: str) -> Column:
        kept = F.filter(matches(text, KINDS[kind], F.col(f"found_{kind}")), lambda s: CHECKS[kind](s["value"]))
        return F.transform(
            kept,
            lambda s: F.struct(
                s["start"].alias("start"),
                F.lit(rank).alias("rank"),
                s["after"].alias("after"),
                F.lit(kind).alias("kind"),
                s["value"].alias("value"),
            ),
        )

    each = [spans(k, kind) for k, kind in enumerate(KINDS)]
    rows = rows.select("id", F.xxhash64("text").alias("text_key"), F.array_sort(F.concat(*each)).alias("spans"), text.alias("blanked"), *others)
    of_rank = lambda rank: F.filter("spans", lambda s: s["rank"] == rank)
    for rank in range(len(KINDS)):  # spans of one kind do not overlap
        rows = rows.withColumn("own", of_rank(rank))
        rows = rows.withColumn("blanked", F.when(F.size("own") > 0, blanked("blanked", "own")).otherwise(F.col("blanked")))
    return rows.drop("own")


def blanked(text: str, spans: str) -> Column:
    """The text with a blank for each character of the spans."""
    until = lambda k: F.coalesce(F.get(spans, k)["after"], F.lit(0))
    pieces = F.transform(
        spans,
        lambda s, k: F.concat(
            F.substring(text, until(k - 1) + 1, s["start"] - until(k - 1)), F.repeat(F.lit(" "), s["after"] - s["start"])
        ),
    )
    return F.concat(F.array_join(pieces, ""), F.substring(text, until(F.size(spans) - 1) + 1, F.char_length(text)))


def entity_of(s: Column) -> Column:
    """What is protected by a span: its kind and its value without differences of writing."""
    plain = F.when(s["kind"] == "email", F.lower(s["value"])).when(s["kind"] == "ip", s["value"])
    return F.concat_ws(":", s["kind"], plain.otherwise(digits(s["value"])))


def terms_of(text: str) -> Column:
    """The different words of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lower))


def disclosing(base: DataFrame, support: int, generalise: float) -> DataFrame:
    """term and the largest disclosure of the terms that give an entity away."""
    total = base.select(F.count("*")).scalar()
    mentions = (
        base.where(F.size("spans") > 0)
        .select("id", "text_key", F.explode(F.array_distinct(F.transform("spans", entity_of))).alias("entity"))
        .distinct()  # repeated rows count once
    )
    entities = (
        mentions.groupBy("entity", "text_key")
        .agg(F.count("*").alias("n"))
        .groupBy("entity")
        .agg(F.sum("n").alias("n_entity"), F.count("*").alias("texts"))
        .where(F.col("texts") >= support)
        .withColumn("n_all", total)
        .where("n_entity < n_all")
        # no term of more documents can disclose so much; a little more for rounding
        .withColumn("most", F.pow("n_all", F.lit(1 - generalise)) * F.pow("n_entity", F.lit(generalise)) * (1 + 1e-6))
        .drop("texts")
    )
    entities = settle(entities, "entities")
    terms = (
        base.select(F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("n_term"))
        .where((F.col("n_term") >= support) & (F.col("n_term") <= entities.select(F.max("most")).scalar()))
    )
    wanted = settle(spread_join(mentions, entities, "entity"), "mentions")
    holders = wanted.select(F.col("id").alias("own_id"), F.col("text_key").alias("own_key")).distinct()
    same = F.col("id").eqNullSafe(F.col("own_id")) & (F.col("text_key") == F.col("own_key"))
    words = (
        base.where(F.size("spans") > 0)
        .join(holders, same, "left_semi")
        .select(F.col("id").alias("own_id"), F.col("text_key").alias("own_key"), F.explode("terms").alias("term"))
    )
    words = spread_join(words, terms, "term").distinct()
    per_text = (
        wanted.join(words, same & (F.col("n_term") <= F.col("most")))
        .groupBy("entity", "term", "text_key", "n_entity", "n_term", "n_all")
        .agg(F.count("*").alias("n"))
    )
    pairs = per_text.groupBy("entity", "term", "n_entity", "n_term", "n_all").agg(
        F.sum("n").alias("n_both"), F.count("*").alias("texts")
    )
    pmi = F.log2(F.col("n_all") * F.col("n_both") / (F.col("n_term") * F.col("n_entity")))
    content = F.log2(F.col("n_all") / F.col("n_entity"))
    scored = pairs.where(F.col("texts") >= support).select("term", (pmi / content).alias("disclosure"))
    return scored.where(F.col("disclosure") >= generalise).groupBy("term").agg(F.max("disclosure").alias("disclosure"))


def occurrences(rows: DataFrame) -> DataFrame:
    """``rows`` with ``extra``: the spans of the words of ``blanked`` that ``marked`` (term, action) has, in order.

    Ends of words are summed up block by block, and terms looked up in buckets:
    neither grows with the square of the text for any usual length.
    """
    rows = rows.withColumn(
        "found",
        F.when(F.col("marked").isNotNull(), F.regexp_extract_all("blanked", F.lit(WORD), F.lit(0))).otherwise(
            F.array().cast("array<string>")
        ),
    )
    gaps = F.slice(F.split("blanked", WORD, -1), 1, F.size("found"))
    steps = F.zip_with(gaps, "found", lambda g, v: F.char_length(g) + F.char_length(v))
    rows = rows.withColumn("steps", F.when(F.size("found") > 0, steps).otherwise(F.array().cast("array<int>")))
    starts = F.sequence(F.lit(1), F.greatest(F.size("steps"), F.lit(1)), F.lit(BLOCK))
    last = lambda a: F.coalesce(F.get(a, F.size(a) - 1), F.lit(0))
    summed = lambda a: F.aggregate(
        a, F.array().cast("array<int>"), lambda acc, x: F.concat(acc, F.array(last(acc) + x))
    )
    rows = rows.withColumn("blocks", F.transform(starts, lambda k: summed(F.slice("steps", k, F.lit(BLOCK)))))
    before = F.concat(F.array(F.lit(0)), summed(F.transform("blocks", last)))
    ends = F.flatten(
        F.zip_with("blocks", F.slice(before, F.lit(1), F.size("blocks")), lambda b, at: F.transform(b, lambda x: x + at))
    )
    rows = rows.withColumn("ends", ends)
    rows = rows.withColumn("n_buckets", F.least(F.lit(1024), F.floor(F.coalesce(F.size("marked"), F.lit(0)) / 8) + 1).cast("int"))
    bucket = lambda term: F.pmod(F.xxhash64(term), F.col("n_buckets")).cast("int")
    rows = rows.withColumn(
        "buckets",
        F.transform(
            F.sequence(F.lit(0), F.col("n_buckets") - 1),
            lambda b: F.filter("marked", lambda m: bucket(m["term"]) == b),
        ),
    )
    action = lambda term: F.get(F.filter(F.get("buckets", bucket(term)), lambda m: m["term"] == term), F.lit(0))["action"]
    spans = F.zip_with(
        "found",
        "ends",
        lambda v, end: F.struct(
            (end - F.char_length(v)).alias("start"),
            F.lit(len(KINDS)).alias("rank"),
            end.alias("after"),
            F.lit("term").alias("kind"),
            F.lower(v).alias("value"),
            action(F.lower(v)).alias("action"),
        ),
    )
    return rows.withColumn("extra", F.filter(spans, lambda s: s["action"].isNotNull()))


def personal_data(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    support: int = SUPPORT,
    generalise: float = GENERALISE,
    remove: float = REMOVE,
) -> DataFrame:
    """id, text_key, spans (start, rank, after, kind, value, and action for terms), in order."""
    found = base_spans(df, id_col, text_col)
    base = settle(found.select("id", "text_key", "spans", terms_of("blanked").alias("terms")), "personal")
    telling = settle(disclosing(base, support, generalise), "telling")
    marked = (
        spread_join(base.select("id", "text_key", F.explode("terms").alias("term")), telling, "term")
        .groupBy(F.col("id").alias("own_id"), F.col("text_key").alias("own_key"))
        .agg(
            F.collect_set(
                F.struct("term", F.when(F.col("disclosure") >= remove, "remove").otherwise("generalise").alias("action"))
            ).alias("marked")
        )
    )
    texts = df.select(col(id_col).alias("id"), text_of(text_col).alias("text")).withColumn("text_key", F.xxhash64("text"))
    joined = texts.join(
        marked.hint("merge"), F.col("id").eqNullSafe(F.col("own_id")) & (F.col("text_key") == F.col("own_key")), "left"
    )
    again = base_spans(joined, "id", "text", "marked")
    plain = F.transform(
        "spans",
        lambda s: F.struct(
            s["start"].alias("start"),
            s["rank"].alias("rank"),
            s["after"].alias("after"),
            s["kind"].alias("kind"),
            s["value"].alias("value"),
            F.lit("replace").alias("action"),
        ),
    )
    both = F.when(F.size("extra") > 0, F.array_sort(F.concat(plain, "extra"))).otherwise(plain)
    return occurrences(again).select(F.col("id").alias(id_col), "text_key", both.alias("spans"))


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The counts, the digest of the base spans and all spans as text."""
    base = F.filter("spans", lambda s: s["rank"] < len(KINDS))
    shown = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["after"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        id_col, *[count(k) for k in KINDS], F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans")
    )


def sanitised(df: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with its text cleaned: data becomes its kind, telling terms a general word or nothing."""
    marks = found.select(col(id_col).alias("own_id"), F.col("text_key").alias("own_key"), "spans").distinct()
    rows = df.select(F.struct("*").alias("row"), col(id_col).alias("id"), text_of(text_col).alias("text"))
    joined = rows.join(
        marks, rows["id"].eqNullSafe(F.col("own_id")) & (F.xxhash64("text") == F.col("own_key")), "left"
    )
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def put(acc: Column, s: Column) -> Column:
        word = F.when(s["action"] == "remove", "").when(s["action"] == "generalise", "<term>").otherwise(
            F.concat(F.lit("<"), s["kind"], F.lit(">"))
        )
        kept = F.substring(F.col("text"), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        inside = s["start"] < acc["at"]  # overlaps a span already replaced
        return F.struct(
            F.greatest(acc["at"], s["after"]).alias("at"),
            F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], kept, word)).alias("out"),
        )

    done = F.aggregate(
        F.coalesce("spans", F.array().cast(found.schema["spans"].dataType)),
        start,
        put,
        lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.char_length("text"))),
    )
    fields = [F.col(f"row.`{f.name}`") if f.name != text_col else done.alias(text_col) for f in df.schema.fields]
    return joined.select(*fields)
