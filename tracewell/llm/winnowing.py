"""Document fingerprints by winnowing, in DataFrame expressions only.

A hash rolls over every run of GRAM words, or of CHARACTER_GRAM code points. Of
each WINDOW neighbouring hashes the smallest is chosen, of equals the rightmost,
and kept with its position. Any run of GRAM + WINDOW - 1 words, or
CHARACTER_GRAM + CHARACTER_WINDOW - 1 code points, that two texts share leaves a
common hash in both fingerprints.

An edited text keeps the choices of all windows before the edit; only what comes
after is hashed again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.operators.relational import global_row_number
from tracewell.session import cut_lineage

GRAM = 5
WINDOW = 8
CHARACTER_GRAM = 32
CHARACTER_WINDOW = 32
LOW = (1 << 32) - 1


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once per row, not once per element of an array."""
    return F.transform(F.array(value), use)[0]


def _run_hashes(text: Column, gram: int, characters: bool) -> Column:
    """Hash and place of every run, one number each: equal hashes order by place, the last one first."""
    if characters:
        units, length, cut, step = F.encode(text, "UTF-32"), F.octet_length, F.substring, 4
    else:
        units, length, cut, step = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""), F.size, F.slice, 1
    run = F.lit(step * gram)

    def roll(u):
        places = F.sequence(F.lit(1), F.greatest(length(u) - run + 1, F.lit(1)), F.lit(step))
        return F.when(length(u) == 0, F.array().cast("array<bigint>")).otherwise(F.transform(
            places, lambda p: F.xxhash64(cut(u, p, run)).bitwiseOR(F.lit(LOW)).bitwiseXOR(p)))

    return _bound(units, roll)


def _window_minima(values: Column, window: int) -> Column:
    """The smallest of each ``window`` neighbours, or of all if there are fewer; empty for none."""
    def with_shifted(shifts):
        return lambda m: F.transform(m, lambda x, i: F.least(x, *[F.get(m, i + s) for s in shifts]))

    at, span = values, 1
    while span < window:
        # Four neighbouring spans at a time; the last ones overlap where the window is no power of four.
        at = _bound(at, with_shifted(sorted({min(span * k, window - span) for k in (1, 2, 3)})))
        span = min(4 * span, window)
    # Past the ends there is nothing, so the minima of the last places are those of shorter windows.
    return _bound(at, lambda m: F.slice(m, F.lit(1), F.least(F.size(m), F.greatest(F.size(m) - (window - 1), F.lit(1)))))


def fingerprints(df: DataFrame, text: str, name: str, gram: int = GRAM, window: int = WINDOW,
                 characters: bool = False, upto: Column | None = None) -> DataFrame:
    """Add ``name``: the chosen hashes of ``text``, each as hash * 2^32 + (2^32 - 1 - place).

    ``text`` must not be null. Places count words from 1, or with ``characters``,
    where every code point counts as a word, four per code point from 1. A text
    with fewer than ``gram`` words has one hash, of all of them; one without
    words has none. With fewer hashes than ``window`` the smallest of all is
    chosen. With ``upto``, a number of units, ``name``_kept says how many of the
    chosen, from the first, come from windows that end within so many.
    """
    df = df.withColumn("_windows", _window_minima(_run_hashes(F.col(text), gram, characters), window))
    df = df.withColumn(name, F.array_distinct("_windows"))
    if upto is not None:
        within = upto - (gram + window - 2)
        df = df.withColumn(f"{name}_kept", F.when(within > 0, F.array_position(F.col(name), F.get("_windows", within - 1)))
                           .otherwise(0).cast("int"))
    return df.drop("_windows")


def hashes(chosen: str) -> Column:
    """The distinct hashes, of 32 bits, without their places: half as long to shuffle as with them."""
    return F.array_distinct(F.transform(chosen, lambda x: F.shiftright(x, 32).cast("int")))


def packed(chosen: str, characters: bool = False) -> dict[str, Column]:
    """The chosen hashes as columns of 4 bytes each, 1 byte of each place, and the rest of the places.

    Places rise along a text, so their upper part is a few long runs, which a
    shuffle compresses to next to nothing.
    """
    unit = lambda x: F.shiftright(F.lit(LOW) - x.bitwiseAND(F.lit(LOW)), 2 if characters else 0)
    return {"_hash": F.transform(chosen, lambda x: F.shiftright(x, 32).cast("int")),
            "_low": F.transform(chosen, lambda x: (unit(x).bitwiseAND(F.lit(255)) - 128).cast("tinyint")),
            "_high": F.transform(chosen, lambda x: F.shiftright(unit(x), 8).cast("int"))}


def unpacked(characters: bool = False) -> Column:
    """The chosen hashes with their places again, from the columns of ``packed``."""
    def joined(value, i):
        unit = F.get("_high", i).cast("bigint") * 256 + F.get("_low", i) + 128
        return F.shiftleft(value.cast("bigint"), 32).bitwiseOR(F.lit(LOW) - (unit * 4 + 1 if characters else unit))

    return F.transform("_hash", joined)


def printed(chosen: str, characters: bool = False) -> Column:
    """``hash:position`` for every chosen hash, in the order of the text; positions count from 0."""
    step = 4 if characters else 1
    return F.array_join(F.transform(chosen, lambda x: F.concat(
        F.lower(F.hex(F.shiftrightunsigned(x, 32))), F.lit(":"),
        F.shiftright(F.lit(LOW - 1) - x.bitwiseAND(F.lit(LOW)), step // 2).cast("string"))), " ")


def likeness(a: str, b: str) -> Column:
    """Jaccard index of two arrays of distinct hashes; 1 if both are empty."""
    def of(both):
        union = F.size(a) + F.size(b) - both
        return F.when(union == 0, F.lit(1.0)).otherwise(both / union)

    return _bound(F.size(F.array_intersect(a, b)), of)


def edited_fingerprints(df: DataFrame, gram: int, window: int, characters: bool) -> DataFrame:
    """Add ``edited_chosen`` from (text, n, third, start, chosen, chosen_kept, edited).

    In code points the windows that end before the last ``third`` of the ``n``
    have chosen already; the rest is hashed from the first place of the first
    window that does not. In words, whose bounds an edit may move, the whole is.
    """
    if not characters:
        return fingerprints(df, "edited", "edited_chosen", gram, window)
    span = gram + window - 1
    before = F.greatest(F.col("n") - F.col("third") - (span - 1), F.lit(0))  # windows kept
    df = df.withColumn("_tail", F.substring("edited", before + 1, F.length("edited")))
    df = fingerprints(df, "_tail", "_tail_chosen", gram, window, True)
    # Behind windows kept, less than a window is no window.
    fresh = F.when((before > 0) & (F.length("_tail") < span), F.array().cast("array<bigint>")).otherwise(
        F.transform("_tail_chosen", lambda x: x - before * 4))
    return df.withColumn("edited_chosen", F.array_distinct(F.concat(
        F.slice("chosen", F.lit(1), F.col("chosen_kept")), fresh))).drop("_tail", "_tail_chosen")


def following(docs: DataFrame) -> DataFrame:
    """(no_id, id, to_no_id, to_id, length): which document lends its start to which.

    ``docs`` has (no_id, id, length). The next document in descending id lends
    to a document, the first one to the last. Rows that repeat an id follow the
    same document; null ids come last and count as one.
    """
    ids = global_row_number(docs.groupBy("no_id", "id").agg(F.max("length").alias("length"))
                            .withColumn("up", ~F.col("no_id")), ["up", "id"], "rank")
    ids = cut_lineage(ids.select("no_id", "id", "length", "rank"))
    n = ids.count()
    to = ids.select(F.col("no_id").alias("to_no_id"), F.col("id").alias("to_id"), "length",
                    F.col("rank").alias("to_rank"))
    lender = ids.select("no_id", "id", (F.col("rank") % F.lit(max(n, 1)) + 1).alias("to_rank"))
    return lender.join(to, "to_rank").drop("to_rank")


def fingerprint_edits(docs: DataFrame, *, key: str = "doc_id", text: str = "text", gram: int = GRAM,
                      window: int = WINDOW, characters: bool = False) -> DataFrame:
    """Fingerprints of every text and of its edited text, with likenesses.

    The edited text has its last third (by code points, rounded down) replaced
    by as many first code points of the next document in descending key, or by
    all of that document if it is shorter; the last document is followed by the
    first. A null text is empty. Rows that repeat a key are followed by the same
    document, and of several with the next key the smallest text is used. Null
    keys come last in descending order. An empty table gives no rows; other
    columns are not read.

    Texts are shuffled once, by key: both uses of ``base`` share that exchange,
    with five bytes and a bit for each hash and its place, and only the replaced
    thirds and hashes travel again.
    """
    id_type = docs.schema[key].dataType
    source = docs.select(
        F.col(key).isNull().alias("no_id"), F.coalesce(F.col(key).cast("long"), F.lit(0).cast("long")).alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))
    pairs = cut_lineage(following(source.select("no_id", "id", F.length("text").alias("length"))))
    n = F.length("text")
    source = source.withColumn("n", n).withColumn("third", F.floor(n / 3).cast("int"))
    base = fingerprints(source, "text", "chosen", gram, window, characters,
                        F.col("n") - F.col("third") if characters else None)
    base = base.withColumns(packed("chosen", characters)).drop("chosen").repartition("no_id", "id")

    # All but the text follow from it: naming them keeps both uses of ``base`` at one exchange.
    first = Window.partitionBy("no_id", "id").orderBy(
        "text", *[c for c in base.columns if c not in ("no_id", "id", "text", "_hash")])
    lent = (base.withColumn("_n", F.row_number().over(first)).filter("_n = 1")
            .join(pairs, ["no_id", "id"])
            .select(F.col("to_no_id").alias("no_id"), F.col("to_id").alias("id"),
                    F.substring("text", F.lit(1), F.floor(F.col("length") / 3).cast("int")).alias("start"),
                    F.array_distinct("_hash").alias("next_hashes")))
    both = base.join(lent, ["no_id", "id"]).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), F.col("n") - F.col("third")),
                           F.substring("start", F.lit(1), F.col("third"))))
    both = both.withColumn("chosen", unpacked(characters))
    out = edited_fingerprints(both, gram, window, characters)
    out = out.withColumn("own", hashes("chosen")).withColumn("changed", hashes("edited_chosen"))
    return out.select(
        F.when(~F.col("no_id"), F.col("id")).cast(id_type).alias(key), F.col("n").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        printed("chosen", characters).alias("fingerprint"),
        printed("edited_chosen", characters).alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"), likeness("own", "next_hashes").alias("near_next"))
