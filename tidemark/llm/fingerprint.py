"""Document fingerprints by SimHash in DataFrame functions alone, and their search in permuted block tables."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import scratch_path

#: A term is a run of so many words; its weight is how often it occurs.
TERM_WORDS = 3
#: Hashes whose bits are added up in one byte each; the sign bit of a long stays clear.
_RUN = 127
_BYTES = 0x0101010101010101
_LEAST = -(1 << 63)


def term_hashes(text: Column) -> Column:
    """XXH64 of every run of TERM_WORDS words, repeats included; a shorter text is one term, none for no words."""
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")

    def runs(w: Column) -> Column:
        hashes, n = F.transform(w, lambda x: F.xxhash64(x)), F.size(w)
        for k in range(1, TERM_WORDS):
            shifted = F.slice(w, k + 1, F.greatest(n - k, F.lit(0)))
            shorter = F.slice(hashes, 1, F.greatest(n - k, F.lit(0)))
            hashes = F.zip_with(shorter, shifted, lambda h, x: F.xxhash64(h, x))
        whole = F.array(F.xxhash64(F.concat_ws(" ", w)))
        return F.when(n >= TERM_WORDS, hashes).when(n > 0, whole).otherwise(F.array().cast("array<bigint>"))

    # bound once: an expression used twice inside array functions is computed twice
    return F.transform(F.array(words), runs)[0]


def simhash(hashes: Column) -> Column:
    """The 64-bit fingerprint: every hash votes on each bit, a bit is set by a majority; no hash, no bit."""

    def fingerprint(h: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(h), F.lit(_RUN))

        def votes(shift: int) -> Column:
            """One long per run of hashes; its bytes count bits shift, shift + 8, ..."""
            return F.transform(
                starts,
                lambda at: F.aggregate(
                    F.slice(h, at, F.lit(_RUN)),
                    F.lit(0).cast("long"),
                    lambda total, x: total + F.shiftrightunsigned(x, shift).bitwiseAND(F.lit(_BYTES)),
                ),
            )

        def count(byte: int, packed: Column) -> Column:
            add = lambda total, x: total + F.shiftrightunsigned(x, 8 * byte).bitwiseAND(F.lit(255))
            return F.aggregate(packed, F.lit(0).cast("long"), add)

        def bits(shift: int, packed: Column) -> Column:
            out = F.lit(0).cast("long")
            for byte in range(8):
                bit = 1 << (8 * byte + shift)
                bit = bit - (1 << 64) if bit >= 1 << 63 else bit
                out = out.bitwiseOR(F.when(count(byte, packed) * 2 > F.size(h), F.lit(bit)).otherwise(F.lit(0).cast("long")))
            return out

        def of_shift(shift: int) -> Column:
            return F.transform(F.array(votes(shift)), lambda packed: bits(shift, packed))[0]

        total = F.lit(0).cast("long")
        for shift in range(8):
            total = total.bitwiseOR(of_shift(shift))
        return F.when(F.size(h) == 0, F.lit(0).cast("long")).otherwise(total)

    return F.transform(F.array(hashes), fingerprint)[0]


def fingerprint(text: Column) -> Column:
    return simhash(term_hashes(text))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits of two fingerprints, 0 to 1."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


# --- the next document ----------------------------------------------------------


def _bucket_of(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most ``key``, in two steps of about the root of their number."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    coarse = F.array(*(F.lit(b) for b in bounds[::step]))
    fine = F.array(*(F.array(*(F.lit(b) for b in bounds[at : at + step])) for at in range(0, len(bounds), step)))
    block = F.size(F.filter(coarse, lambda b: b <= key))
    inside = F.size(F.filter(F.get(fine, block - 1), lambda b: b <= key))
    return F.when(block == 0, 0).otherwise((block - 1) * step + inside)


def with_next(docs: DataFrame, columns: list[str], buckets: int) -> DataFrame:
    """Each row with the ``next_`` columns of the row that follows by doc_id; the first follows the last.

    Rows are dealt into ranges of doc_id. The first row of a range is also
    dealt to the end of the range before it, so no range needs another's rows
    and none holds more than its share. Null ids come first; equal ids are
    ordered by the hash of their text. What goes to the driver is one bound
    and one first key per range.
    """
    keyed = docs.withColumn("_key", F.coalesce("doc_id", F.lit(_LEAST)))
    cuts = [i / buckets for i in range(1, buckets)]
    bounds = keyed.agg(F.percentile_approx("_key", cuts, 10_000)).head()[0] if cuts else None
    bounds = sorted(set(bounds or []))
    keyed = keyed.withColumn("_bucket", _bucket_of(F.col("_key"), bounds).cast("int"))
    firsts = keyed.groupBy("_bucket").agg(F.min("_key").alias("k")).orderBy("_bucket").collect()
    if not firsts:
        return docs.select("*", *(F.col(c).alias(f"next_{c}") for c in columns))
    first_key, before = [None] * (len(bounds) + 1), [0] * (len(bounds) + 1)
    for at, row in enumerate(firsts):
        first_key[row["_bucket"]], before[row["_bucket"]] = row["k"], firsts[at - 1]["_bucket"]
    own = F.struct(F.col("_bucket").alias("bucket"), F.lit(False).alias("ghost"))
    ghost = F.struct(F.get(F.array(*map(F.lit, before)), F.col("_bucket")).alias("bucket"), F.lit(True).alias("ghost"))
    is_first = F.col("_key") == F.get(F.array(*map(F.lit, first_key)), F.col("_bucket"))
    dealt = keyed.withColumn("_at", F.explode(F.when(is_first, F.array(own, ghost)).otherwise(F.array(own))))
    order = Window.partitionBy("_at.bucket").orderBy("_at.ghost", "_key", F.xxhash64("text"))
    led = dealt.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in columns))
    return led.where(~F.col("_at.ghost")).drop("_key", "_bucket", "_at")


def edited_text() -> Column:
    """The text with its last half replaced by as much of the next text's beginning."""
    half = F.floor(F.char_length("text") / 2).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), F.char_length("text") - half)
    return F.concat(kept, F.substring(F.col("next_text"), F.lit(1), half))


# --- permuted block tables --------------------------------------------------------


def block_tables(radius: int, blocks: int) -> Column:
    """One entry per choice of ``blocks - radius`` blocks: their mask, and the masks that must differ.

    Fingerprints within ``radius`` agree on that many blocks at least. A pair
    counts in the table of the first blocks it agrees on alone.
    """
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    mask = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(cuts)]

    def signed(m: int) -> Column:
        return F.lit(m - (1 << 64) if m >= 1 << 63 else m).cast("long")

    entries = []
    for t, chosen in enumerate(itertools.combinations(range(blocks), blocks - radius)):
        others = [signed(mask[j]) for j in range(chosen[-1]) if j not in chosen]
        others += [signed(-1 % (1 << 64))] * (radius - len(others))
        entries.append(
            F.struct(F.lit(t).alias("t"), signed(sum(mask[j] for j in chosen)).alias("mask"), F.array(*others).alias("differ"))
        )
    return F.array(*entries)


def count_within(prints: DataFrame, queries: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """(fp, n_within): rows of ``prints`` (fp) within ``radius`` bits of each distinct fp of ``queries``, itself included.

    Equal fingerprints are counted before they are dealt into the tables, so
    groups of copies cost one row each; pairs are verified in the join.
    """
    tables = F.explode(block_tables(radius, blocks))
    held = prints.groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
    asked = queries.select("fp").distinct()
    # each side is many times the table that its size is guessed from: sorted, not broadcast
    left = asked.select("fp", tables.alias("g")).hint("merge").select(
        "fp", F.col("g.t").alias("t"), F.col("fp").bitwiseAND(F.col("g.mask")).alias("key"), F.col("g.differ").alias("differ")
    )
    right = held.select(F.col("fp").alias("other"), "n", tables.alias("g")).select(
        "other", "n", F.col("g.t").alias("t"), F.col("other").bitwiseAND(F.col("g.mask")).alias("key")
    )
    x = F.col("fp").bitwiseXOR(F.col("other"))
    verified = (F.bit_count(x) <= radius) & (x != 0)
    for i in range(radius):
        verified &= x.bitwiseAND(F.get("differ", F.lit(i))) != 0
    pairs = left.join(right, ["t", "key"]).where(verified)
    found = pairs.select("fp", "n").unionByName(held.join(asked, "fp", "left_semi").select("fp", "n"))
    return found.groupBy("fp").agg(F.sum("n").alias("n_within"))


def document_fingerprints(docs: DataFrame, query_every: int = 50, radius: int = 3) -> DataFrame:
    """Fingerprints of every text of (doc_id, text) and of its edited text, and how near they are.

    Rows: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, and n_within for every ``query_every``-th doc_id:
    other rows whose fingerprint differs in at most ``radius`` bits (null for
    the rest). A null text counts as empty, an empty text has no bit set; a
    single row is its own next one; null ids come first; an empty table gives
    no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumn("fp", fingerprint(F.col("text")))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    led = with_next(texts, ["text", "fp"], buckets).withColumn("edited", edited_text())
    led = led.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fp",
        fingerprint(F.col("edited")).alias("edited_fp"),
        "next_fp",
    )
    path = scratch_path(spark, "fingerprints")
    led.write.parquet(path)
    led = spark.read.parquet(path)
    asked = F.col("doc_id") % query_every == 0
    counts = count_within(led.select("fp"), led.where(asked).select("fp"), radius)
    return led.join(counts, "fp", "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_hex(F.col("fp")).alias("fingerprint"),
        as_hex(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        F.when(asked, F.col("n_within") - 1).alias("n_within"),
    )
