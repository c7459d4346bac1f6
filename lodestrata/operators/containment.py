"""Containment join: rows whose text holds every part of a needle.

A substring test has no join key, so the plain formulation compares every pair.
Here every distinct part gets a key that the texts holding it must share: one of its grams, runs
of characters as long as the part allows (LEVELS). An equi-join on it misses nothing, and the
substring test then removes what is only similar. Parts are found in texts one by one, and
the needles are then joined by all their parts: a part that very many texts and very many
needles have costs its own occurrences, not their product.

* Few parts (count and size checked first): their keys are broadcast and probed while the
  texts stream by. The texts are not shuffled.
* Otherwise: texts are written once with a key of their own. Their grams are cut down to
  what parts use before anything is shuffled, each part takes its rarest gram, and a gram
  that is still frequent is split over as many tasks as its count asks for.

Both ways give the same rows, also for texts with null or repeated ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.session import stage

# Lengths of grams; a part is keyed by the longest that fits. An empty part has the empty gram.
LEVELS = (0, 1, 2, 4, 8, 16)
BROADCAST_NEEDLES = 200_000
BROADCAST_CHARS = 32_000_000
# Rows of one gram that a task should see at most.
ROWS_PER_SALT = 200_000
# Slots of the filter that keeps grams no part uses out of the shuffle: its size is
# fixed, whatever the number of parts.
FILTER_SLOTS = 1 << 21


def _grams(text: Column, length: int) -> Column:
    """Hashes of all runs of ``length`` characters, spaces included."""
    if not length:
        return F.array(F.xxhash64(F.lit("")))
    runs = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{length}}}))"), 1)
    return F.transform(runs, lambda run: F.xxhash64(run))


def level_of(part: Column) -> Column:
    """The longest gram length that a part allows."""
    found = F.lit(0)
    for n in LEVELS[1:]:
        found = F.when(F.length(part) >= n, n).otherwise(found)
    return found


def part_grams(part: Column) -> Column:
    """Grams of a part, all of its level."""
    level, found = level_of(part), _grams(part, 0)
    for n in LEVELS[1:]:
        found = F.when(level == n, F.array_distinct(_grams(part, n))).otherwise(found)
    return found


def text_grams_of(text: Column, levels: Sequence[int] = LEVELS) -> Column:
    """Grams of a text in the lengths that parts use."""
    return F.array_distinct(F.concat(*[_grams(text, n) for n in sorted(levels)]))


def holds(text: Column, parts: Sequence[str]) -> Column:
    test = F.contains(text, F.col(parts[0]))
    for p in parts[1:]:
        test = test & F.contains(text, F.col(p))
    return test


def parts_of(needles: DataFrame, parts: Sequence[str]) -> DataFrame:
    """(_part, _use): every distinct part once; bit i of `_use` is set if it is an i-th part."""
    listed = F.array(*[F.struct(F.col(p).alias("_part"), F.lit(1 << i).alias("_use")) for i, p in enumerate(parts)])
    rows = needles.select(F.explode(listed).alias("p")).select("p.*")
    return rows.groupBy("_part").agg(F.bit_or("_use").alias("_use"))


def _as_part(i: int):
    return lambda h: F.when(h["_use"].bitwiseAND(F.lit(1 << i)) != 0, h["_part"])


def together(hits: DataFrame, row: str, parts: Sequence[str]) -> DataFrame:
    """(row, _part, _use) found -> row and `parts`: what needles would have to be to match a row."""
    found = hits.groupBy(row).agg(F.collect_list(F.struct("_part", "_use")).alias("_hits"))
    for i, p in enumerate(parts):
        own = F.transform("_hits", _as_part(i))
        found = found.withColumn(p, F.explode(F.array_compact(own)))
    return found.drop("_hits")


def contains_match(
    needles: DataFrame,
    texts: DataFrame,
    parts: Sequence[str],
    text: str,
    allow_empty: bool = False,
    strategy: str = "auto",
) -> DataFrame:
    """Pairs (needle row, text row) where the text contains all needle parts.

    Repeated needles count once; repeated text rows give their matches each. An
    empty part is contained in every text: such needles are left out unless
    ``allow_empty``. ``strategy`` is ``auto``, ``broadcast`` (still only within the
    measured bounds) or ``shuffle``.
    """
    if strategy not in ("auto", "broadcast", "shuffle"):
        raise ValueError(f"unknown strategy {strategy!r}")
    for p in parts:
        needles = needles.filter(F.col(p).isNotNull())
        if not allow_empty:
            needles = needles.filter(F.col(p) != "")
    # The distinct needles and their parts are read several times below, so they are written once.
    needles = stage(needles.dropDuplicates(), "needles")
    pieces = stage(parts_of(needles, parts).withColumn("_level", level_of(F.col("_part"))), "parts")
    # One small pass over them: how many, how large, which gram lengths.
    uses = [F.col("_use").bitwiseAND(F.lit(1 << i)) != 0 for i in range(len(parts))]
    facts = pieces.agg(
        F.count("*").alias("n"),
        F.sum(F.length("_part")).alias("chars"),
        F.array(*[F.collect_set(F.when(use, F.col("_level"))) for use in uses]).alias("levels"),
        F.array(*[F.count_if(use) for use in uses]).alias("uses"),
    ).first()
    pieces = pieces.withColumn("_grams", part_grams(F.col("_part"))).drop("_level")
    if strategy != "shuffle" and _small(facts.n, facts.chars):
        return _probe(needles, pieces, texts, parts, text, facts)
    return _blocked(needles, pieces, texts, parts, text, set().union(*facts.levels))


def _small(n: int, chars: int | None) -> bool:
    return n <= BROADCAST_NEEDLES and (chars or 0) <= BROADCAST_CHARS


def _rarest(pieces: DataFrame, frequency: DataFrame) -> DataFrame:
    """(_part, _use, _gram, _n): parts with the gram that is least frequent."""
    rated = (
        pieces.select("_part", "_use", F.explode("_grams").alias("_gram"))
        .join(frequency, "_gram", "left")
        .select("_part", "_use", F.struct(F.coalesce("_n", F.lit(0)).alias("_n"), "_gram").alias("_key"))
    )
    rarest = rated.groupBy("_part", "_use").agg(F.min("_key").alias("_key"))
    return rarest.select("_part", "_use", "_key._gram", "_key._n")


def _probe(
    needles: DataFrame, pieces: DataFrame, texts: DataFrame, parts: Sequence[str], text: str, facts
) -> DataFrame:
    # How often the parts use a gram is a fair guess at how common it is, and
    # it saves reading the texts twice. The guess decides speed, never rows.
    use = pieces.select(F.explode("_grams").alias("_gram")).groupBy("_gram").agg(
        F.count("*").alias("_n")
    )
    keys = stage(_rarest(pieces, use).drop("_n"), "part_keys")
    rows = texts
    # The part with the fewest values first: what it does not find is not probed again.
    for i in sorted(range(len(parts)), key=lambda i: facts.uses[i]):
        own = keys.filter(F.col("_use").bitwiseAND(F.lit(1 << i)) != 0)
        own = own.select(F.col("_gram").alias("_key"), F.col("_part").alias(f"_part{i}"))
        probed = rows.withColumn("_gram", F.explode(text_grams_of(F.col(text), facts.levels[i] or LEVELS[:1])))
        test = (F.col("_gram") == F.col("_key")) & F.contains(F.col(text), F.col(f"_part{i}"))
        rows = probed.join(F.broadcast(own), test).drop("_gram", "_key")
    width = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in needles.columns]))
    size = needles.agg(F.count("*").alias("n"), F.sum(width).alias("chars")).first()
    needles = F.broadcast(needles) if _small(size.n, size.chars) else needles.hint("merge")
    for i, p in enumerate(parts):
        needles = needles.withColumnRenamed(p, f"_part{i}")
    met = rows.join(needles, [f"_part{i}" for i in range(len(parts))])
    for i, p in enumerate(parts):
        met = met.withColumnRenamed(f"_part{i}", p)
    return met


def slot(gram: str) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(FILTER_SLOTS)).cast("int")


def of_used_grams(rows: DataFrame, used: DataFrame, gram: str) -> DataFrame:
    """Rows whose gram may be one of the used ones; at most FILTER_SLOTS numbers are broadcast."""
    slots = F.broadcast(used.select(slot(gram).alias("_slot")).distinct())
    return rows.withColumn("_slot", slot(gram)).join(slots, "_slot", "left_semi").drop("_slot")


def _blocked(
    needles: DataFrame,
    pieces: DataFrame,
    texts: DataFrame,
    parts: Sequence[str],
    text: str,
    levels: Sequence[int],
) -> DataFrame:
    # The texts are computed once, and every row gets a key that later reads agree on.
    texts = stage(texts.withColumn("_row", F.monotonically_increasing_id()), "texts")
    used = pieces.select(F.explode("_grams").alias("_gram"))
    text_grams = texts.select("_row", F.explode(text_grams_of(F.col(text), levels or LEVELS[:1])).alias("_gram"))
    text_grams = stage(of_used_grams(text_grams, used, "_gram"), "text_grams")
    frequency = text_grams.groupBy("_gram").agg(F.count("*").alias("_n"))
    # A part whose rarest gram is nowhere in the texts has no match.
    keys = _rarest(pieces, frequency).filter(F.col("_n") > 0)
    keys = keys.withColumn("_salts", F.ceil(F.col("_n") / ROWS_PER_SALT).cast("int")).drop("_n")
    keys = stage(keys, "part_keys")
    chosen = keys.select("_gram", "_salts").distinct()
    spread_texts = text_grams.join(chosen, "_gram").select(
        "_gram", "_row", F.pmod(F.xxhash64("_row"), "_salts").cast("int").alias("_salt")
    )
    spread_keys = keys.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
    candidates = spread_texts.join(spread_keys.drop("_salts"), ["_gram", "_salt"])
    # Only the row key travels with a gram; the text is joined back for the test.
    hits = texts.select("_row", F.col(text).alias("_text")).join(candidates.drop("_gram", "_salt"), "_row")
    hits = hits.filter(F.contains("_text", "_part")).select("_row", "_part", "_use")
    met = together(hits, "_row", parts).join(needles, list(parts))
    return texts.join(met, "_row").drop("_row")
