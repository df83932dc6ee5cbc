"""Line deduplication: repeated passages of lines, whatever stands around them.

Built-in functions only.  The units that are looked up in all texts are

* every pair of neighbouring visible lines, with the blank lines between them,
* every single line of ``LONG_LINE`` characters or more, and
* content-defined chunks: a hash over ``window`` consecutive line hashes rolls
  along a text, and a chunk begins where it has a local minimum.  They take the
  blank lines at the ends of passages too.

Units overlap, so a passage that stands in several texts is covered from its
first line to its last in each of them: a match grows over neighbouring lines
as long as the next pair is repeated too.

1. Units are compared by a narrow table of their hashes; the first unit (by
   id, then place) of each hash that occurs more than once is the keeper.
2. The keepers' bytes are taken from their texts and go to the other members.
3. A member is removed from its text if its bytes equal the keeper's and it does
   not overlap the keeper.  The first place of a line is in no member, so every
   line stays somewhere.

Only the hashes of the units and the texts of repeated ones are shuffled by
content; a unit that a third of all texts hold is one row per text there, and
AQE splits it.

Defined results: a null text is empty and has one empty line; single lines under
``LONG_LINE`` and units without a visible character stay; lines end at ``\\n`` only.
``n_chunks`` counts the removed passages: runs of neighbouring removed lines.
Null ids come last.  Rows that repeat an id and its text are one text: all of
them keep or lose the same chunks.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.common import col, settle, spread_join, text_of

WINDOW = 2
#: a line of so many characters is a passage by itself; one of over 50 words has at least as many
LONG_LINE = 100
VISIBLE = r"[^\x00-\x20]"


def lines_of(text: str | Column) -> Column:
    return F.split(text, "\n", -1)


def chunks(df: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """id, text_key, digest, first and after (line numbers) of all units: chunks of two lines or more, pairs, long lines."""
    rows = df.select(
        col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("text_key"), lines_of(text_of(text_col)).alias("lines")
    )
    rows = rows.withColumn("hashes", F.transform("lines", lambda line: F.xxhash64(line)))
    rows = rows.withColumn(
        "rolled",
        F.transform(
            "hashes",
            lambda h, i: F.when(i >= window - 1, F.xxhash64(*[F.get("hashes", i - window + 1 + j) for j in range(window)])),
        ),
    )
    n = F.size("lines")
    at = lambda i: F.get("rolled", i)
    begins = F.filter(
        F.sequence(F.lit(0), n - 1),
        lambda i: (i == 0) | (F.coalesce((at(i) < at(i - 1)) & (at(i) <= at(i + 1)), F.lit(False))),
    )
    rows = rows.withColumn("begins", begins)
    spans = F.transform(
        "begins",
        lambda b, k: F.struct(b.alias("first"), F.coalesce(F.get("begins", k + 1), n).alias("after")),
    )
    seen = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get("lines", i).rlike(VISIBLE))
    rows = rows.withColumn("spans", F.filter(spans, lambda s: s["after"] - s["first"] >= 2)).withColumn("seen", seen)
    # A unit is one number here: sets of numbers are hashed, sets of structs compare all pairs.  The length comes
    # first: Spark's hash mixes both halves by exclusive or, and first ^ after is almost the same for all units.
    unit = lambda first, after: F.shiftleft((after - first).cast("long"), 32) + first
    whole = F.transform("spans", lambda s: unit(s["first"], s["after"]))
    pairs = F.transform(
        F.slice("seen", 1, F.greatest(F.size("seen") - 1, F.lit(0))), lambda i, k: unit(i, F.get("seen", k + 1) + 1)
    )
    long_lines = F.transform(
        F.filter("seen", lambda i: F.char_length(F.get("lines", i)) >= LONG_LINE), lambda i: unit(i, i + 1)
    )
    rows = rows.withColumn("units", F.array_distinct(F.concat(whole, pairs, long_lines)))
    first = lambda u: u.bitwiseAND((1 << 32) - 1).cast("int")
    spans = F.transform(
        "units",
        lambda u: F.struct(first(u).alias("first"), (first(u) + F.shiftright(u, 32).cast("int")).alias("after")),
    )
    own = F.transform(
        spans,
        lambda s: F.struct(
            s["first"].alias("first"),
            s["after"].alias("after"),
            piece("lines", s).alias("piece"),
        ),
    )
    visible = F.filter(own, lambda s: s["piece"].rlike(VISIBLE))
    made = F.transform(
        visible,
        lambda s: F.struct(F.xxhash64(s["piece"]).alias("digest"), s["first"].alias("first"), s["after"].alias("after")),
    )
    return exploded(rows.select("id", "text_key", made.alias("made")), "made")


def exploded(df: DataFrame, units: str) -> DataFrame:
    """One row for each struct in ``units``, spread out, beside the other columns.

    The outer form: for ``explode`` Spark adds a filter on the array's size and
    pushes it down to the text, where it splits the text again for every unit.
    """
    others = [c for c in df.columns if c != units]
    return df.select(*others, F.explode_outer(units).alias("_u")).where("_u IS NOT NULL").select(*others, "_u.*")


def piece(lines: str, span: Column) -> Column:
    """The lines of a span as one text; taken one by one, because ``slice`` copies the whole array first."""
    return F.array_join(F.transform(F.sequence(span["first"], span["after"] - 1), lambda k: F.get(lines, k)), "\n")


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """All columns of ``df`` with the text shortened, in ``row``, and id, n_lines, n_removed, n_chunks beside it."""
    cut = settle(chunks(df, id_col, text_col, window), "chunks")
    place = F.struct(F.col("id").isNull().alias("nameless"), "id", "text_key", "first", "after")
    repeated = settle(
        cut.groupBy("digest").agg(F.min(place).alias("keeper"), F.count("*").alias("n")).where("n > 1").drop("n"), "repeated"
    )
    same = lambda k: F.col("id").eqNullSafe(F.col(f"{k}.id")) & (F.col("text_key") == F.col(f"{k}.text_key"))
    members = spread_join(cut, repeated, "digest").where(~(same("keeper") & (F.col("first") < F.col("keeper.after"))))
    # the columns beside id and text under names of their own; without any, both joins read one exchange of the texts
    others = {f"_c{k}": f.name for k, f in enumerate(df.schema.fields) if f.name not in (id_col, text_col)}
    texts = df.select(
        col(id_col).alias("id"),
        F.xxhash64(text_of(text_col)).alias("text_key"),
        col(text_col).alias("text"),
        *[col(name).alias(own) for own, name in others.items()],
    )
    whole = F.coalesce(F.col("text").cast("string"), F.lit(""))
    wanted = repeated.groupBy(F.col("keeper.id").alias("own_id"), F.col("keeper.text_key").alias("own_key")).agg(
        F.collect_list(F.struct("digest", F.col("keeper.first").alias("first"), F.col("keeper.after").alias("after"))).alias("own")
    )
    own_text = F.col("id").eqNullSafe(F.col("own_id")) & (F.col("text_key") == F.col("own_key"))
    # named twice here, the lines are split once; named once, Spark would split the text again for every unit
    taken = lambda s: F.struct(s["digest"].alias("digest"), piece("lines", s).alias("piece"))
    kept = (
        texts.join(wanted.hint("merge"), own_text)
        .select("own", lines_of(whole).alias("lines"))
        .select(F.when(F.size("lines") > 0, F.transform("own", taken)).alias("pieces"))
    )
    kept = (
        exploded(kept, "pieces")
        .groupBy("digest")  # rows that repeat a keeper's id and text
        .agg(F.first("piece").alias("piece"))
    )
    doomed = (
        spread_join(members.select("id", "text_key", "digest", "first", "after"), kept, "digest")
        .groupBy(F.col("id").alias("own_id"), F.col("text_key").alias("own_key"))
        .agg(F.collect_set(F.struct("first", "after", "piece")).alias("own"))
    )
    joined = texts.join(doomed.hint("merge"), own_text, "left").withColumn("lines", lines_of(whole))
    joined = joined.withColumn("gone", F.filter("own", lambda s: s["piece"] == piece("lines", s)))
    some = F.col("gone").isNotNull() & (F.size("gone") > 0)
    # by sets of line numbers: linear in the lines, however many units are gone
    numbers = F.flatten(F.transform("gone", lambda s: F.sequence(s["first"], s["after"] - 1)))
    joined = joined.withColumn("numbers", F.when(some, F.array_sort(F.array_distinct(numbers))))
    kept_numbers = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("numbers"))
    left = F.transform(kept_numbers, lambda i: F.get("lines", i))
    runs = F.filter("numbers", lambda i, k: (k == 0) | (F.get("numbers", k - 1) < i - 1))
    joined = joined.withColumn("left", F.when(some, left).otherwise(F.col("lines")))
    text = F.when(some, F.array_join("left", "\n")).otherwise(F.col("text"))
    own_name = {id_col: F.col("id"), text_col: text} | {name: F.col(own) for own, name in others.items()}
    fields = [own_name[name].alias(name) for name in df.columns]
    return joined.select(
        "id",
        F.struct(*fields).alias("row"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("left")).cast("long").alias("n_removed"),
        F.when(some, F.size(runs)).otherwise(0).cast("long").alias("n_chunks"),
    )


def shortened(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``df`` without its repeated passages."""
    return line_dedup(df, id_col, text_col, window).select("row.*")
