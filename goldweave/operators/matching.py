"""Duplicate detection by exact keys and by weighted name/address similarity.

Matches are kept in factored form. A key shared by ``n`` records is one row
with its size and its smallest id (the anchor), and records that look alike
to the similarity rule form one profile. Pair counts and score sums follow
from the sizes, so no step lists the pairs inside a group.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldweave.config import FUZZY_NAME_ADDRESS, LEI_EXACT, TAX_ID_EXACT, MasteringConfig
from goldweave.functions.similarity import char_mask, jaro_winkler_bound, matched_in_cell, native_traits, weighted_similarity
from goldweave.functions.text import clean_key, filled

# Key kind of records that agree on both identifiers; it corrects the overlap of the two exact kinds.
TAX_AND_LEI = "TAX_AND_LEI"

_KEY = ["match_type", "key_1", "key_2"]
_PROFILE = ["source_system", "state", "city_key", "postal_code", "name_key", "address_key"]
_SIDE = ["profile_id", "members", *_PROFILE]
_BLOCK = ["state", "place_kind", "place"]
_CELL = [*_BLOCK, "cell_row", "cell_column"]

# Pairs of a block from which on its cells are compared as arrays: there that is ten times faster than a join, in smaller ones a call costs more.
_DENSE_PAIRS = 1 << 16

# An array cell has so many times the rows of a join's cell: what it holds is a few megabytes, and each row goes to fewer cells.
_DENSE_CELLS = 8


def pair_count(members: Column) -> Column:
    """Unordered pairs in a group of ``members``; exact far beyond 64 bits."""
    n = members.cast("decimal(19,0)")
    return F.floor(n * (n - 1) / 2).cast("decimal(38,0)")


def _exact_keys(parties: DataFrame, *others: Column) -> DataFrame:
    tax, lei = filled("tax_id"), filled("lei")
    key = lambda kind, present, a, b: F.when(
        present, F.struct(F.lit(kind).alias("match_type"), a.alias("key_1"), b.alias("key_2"))
    )
    keys = F.array_compact(
        F.array(
            key(TAX_ID_EXACT, tax.isNotNull(), tax, F.lit("")),
            key(LEI_EXACT, lei.isNotNull(), lei, F.lit("")),
            key(TAX_AND_LEI, tax.isNotNull() & lei.isNotNull(), tax, lei),
        )
    )
    rows = parties.select("id", "source_system", *others, F.explode(keys).alias("k"))
    return rows.select(*[c for c in rows.columns if c != "k"], "k.*")


def exact_groups(parties: DataFrame) -> DataFrame:
    """Identifier values shared by two or more records: size, pair count, smallest id."""
    return (
        _exact_keys(parties)
        .groupBy(*_KEY)
        .agg(F.count(F.lit(1)).alias("members"), F.min("id").alias("anchor_id"))
        .filter("members > 1")
        .withColumn("pairs", pair_count(F.col("members")))
    )


def exact_members(parties: DataFrame, groups: DataFrame) -> DataFrame:
    """Records of each shared identifier, with the anchor of their group."""
    return _exact_keys(parties).join(groups.select(*_KEY, "members", "anchor_id"), _KEY)


def exact_links(parties: DataFrame) -> DataFrame:
    """One row per record and shared identifier, pointing at the group's smallest id.

    The rows of a group stand for all its pairs, each with score 1.0;
    ``pairs`` on every row says how many those are.
    """
    members = exact_members(parties, exact_groups(parties)).filter(F.col("match_type") != TAX_AND_LEI)
    return members.select(
        "match_type", F.col("key_1").alias("match_key"), "anchor_id", "id", "members",
        pair_count(F.col("members")).alias("pairs"), F.lit(1.0).alias("score"),
    )


def _ignores_text(cfg: MasteringConfig) -> bool:
    return cfg.binarize_threshold is not None and cfg.binarize_threshold <= 0


def _place_score(cfg: MasteringConfig, same_city: bool, same_postal: bool) -> float | None:
    """Score of a pair whose texts do not count, None below the threshold; the same sum and the same rounding as column by column."""
    raw = (same_city * cfg.city_weight + same_postal * cfg.postal_weight) + cfg.name_weight + cfg.address_weight
    rounded = lambda value, places: float(Decimal(repr(value)).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))
    total = rounded(raw, 10)
    return rounded(total, 4) if total >= cfg.fuzzy_threshold else None


def _place_scores(cfg: MasteringConfig, same_city: Column, same_postal: Column) -> Column:
    """:func:`_place_score` as a column; NULL below the threshold."""
    score = lambda *agree: F.lit(_place_score(cfg, *agree)).cast("double")
    by_postal = lambda city: F.when(same_postal, score(city, True)).otherwise(score(city, False))
    return F.when(same_city, by_postal(True)).otherwise(by_postal(False))


def _source_rank(cfg: MasteringConfig) -> Column:
    pairs = [F.lit(x) for i, s in enumerate(cfg.compared_sources) for x in (s, i)]
    return F.create_map(*pairs)[F.col("source_system")]


def _compared(cfg: MasteringConfig) -> Column:
    return F.col("state").isNotNull() & F.col("source_system").isin(*cfg.compared_sources)


def _comparison_columns(parties: DataFrame, cfg: MasteringConfig) -> DataFrame:
    blank = F.lit("")
    texts = (blank, blank) if _ignores_text(cfg) else (clean_key("full_name"), clean_key("address_line1"))
    return parties.filter(_compared(cfg)).select(
        "id", "source_system", "state", clean_key("city").alias("city_key"), "postal_code",
        texts[0].alias("name_key"), texts[1].alias("address_key"),
    )


def match_keys(parties: DataFrame, cfg: MasteringConfig) -> DataFrame:
    """(id, exact, key): what another record must share to match a record: an identifier, or a block of the similarity rule."""
    exact = _exact_keys(parties).filter(F.col("match_type") != TAX_AND_LEI).select(
        "id", F.lit(True).alias("exact"), F.concat_ws("|", "match_type", "key_1").alias("key"))
    blocks = _comparison_columns(parties, cfg).select("id", F.lit(False).alias("exact"), F.explode(_places(cfg)).alias("p"), "state").select(
        "id", "exact", F.concat_ws("|", "p.place_kind", "state", "p.place").alias("key"))
    return exact.unionByName(blocks)


def profiles(parties: DataFrame, cfg: MasteringConfig) -> DataFrame:
    """Distinct inputs of the similarity rule with their record count and smallest id."""
    return (
        _comparison_columns(parties, cfg)
        .groupBy(*_PROFILE)
        .agg(F.min("id").alias("profile_id"), F.count(F.lit(1)).alias("members"))
    )


def _places(cfg: MasteringConfig) -> Column:
    """Places below the state that a match must share one of."""
    place = lambda kind, value: F.struct(F.lit(kind).alias("place_kind"), value.alias("place"))
    if not cfg.needs_place_agreement:
        return F.array(place("state", F.lit("")))
    postal = F.when(F.col("postal_code").isNotNull(), place("postal", F.col("postal_code")))
    return F.array_compact(F.array(place("city", F.col("city_key")), postal))


def blocked_profiles(profile: DataFrame, cfg: MasteringConfig) -> DataFrame:
    """Profiles under each block key they can match in, with the block's grid size.

    When name and address together stay below the threshold, every match
    agrees on city or postal code, so those replace the block on state alone.
    A block larger than ``block_cell_rows`` on a side (dense ones: some times
    that) is cut into a grid whose cells each hold a bounded number of rows;
    every pair meets in one cell.
    """
    last = len(cfg.compared_sources) - 1
    keyed = (
        profile.withColumn("source_rank", _source_rank(cfg))
        .withColumn("p", F.explode(_places(cfg)))
        .select(*_PROFILE, "profile_id", "members", "source_rank", "p.place_kind", "p.place")
    )
    sizes = (
        keyed.groupBy(*_BLOCK)
        .agg(
            F.count_if(F.col("source_rank") < last).alias("n_left"),
            F.count_if(F.col("source_rank") > 0).alias("n_right"),
            F.min("source_rank").alias("lowest"),
            F.max("source_rank").alias("highest"),
        )
        .filter("lowest < highest")
        .withColumn("dense", F.col("n_left") * F.col("n_right") >= _DENSE_PAIRS if not _ignores_text(cfg) else F.lit(False))
        .withColumn("most", F.when(F.col("dense"), cfg.block_cell_rows * _DENSE_CELLS).otherwise(cfg.block_cell_rows))
        .select(
            *_BLOCK,
            F.ceil(F.col("n_left") / F.col("most")).alias("rows_of_cells"),
            F.ceil(F.col("n_right") / F.col("most")).alias("columns_of_cells"),
            "dense",
        )
    )
    fitted = keyed.join(sizes, _BLOCK).withColumns({"city_hash": F.xxhash64("city_key"), "postal_hash": F.xxhash64("postal_code")})
    if _ignores_text(cfg):
        return fitted
    # A cell of a dense block makes sets of its own.
    masks = {f"{text}_mask": char_mask(F.when(~F.col("dense"), F.col(f"{text}_key"))) for text in ("name", "address")}
    return fitted.withColumns({**masks, **native_traits("name_key", "name"), **native_traits("address_key", "address")})


def _best_text(text: str, cfg: MasteringConfig) -> str:
    """SQL of the highest similarity a text of sides ``l`` and ``r`` can have."""
    if _ignores_text(cfg):
        return "1D"
    bound = jaro_winkler_bound(text)
    if cfg.binarize_threshold is None:
        return bound
    return f"IF({bound} >= {cfg.binarize_threshold - 1e-9}D, 1D, 0D)"


def _cell_sides(blocked: DataFrame, cfg: MasteringConfig) -> tuple[DataFrame, DataFrame]:
    """The rows of each block dealt out to its cells, as left and as right sides."""
    slot = lambda count: F.pmod(F.xxhash64("profile_id"), F.col(count))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(count) - 1))
    # The work of a cell grows with its pairs, not its bytes: a fixed partition count keeps cells from being packed together.
    tasks = int(blocked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = (
        blocked.filter(F.col("source_rank") < len(cfg.compared_sources) - 1)
        .withColumn("cell_row", slot("rows_of_cells"))
        .withColumn("cell_column", every("columns_of_cells"))
        .repartition(tasks, *_CELL)
    )
    right = (
        blocked.filter(F.col("source_rank") > 0)
        .withColumn("cell_column", slot("columns_of_cells"))
        .withColumn("cell_row", every("rows_of_cells"))
        .repartition(tasks, *_CELL)
    )
    return left, right


def _candidates(blocked: DataFrame, cfg: MasteringConfig, only: str = "true") -> DataFrame:
    """Cross-source profile pairs whose best possible score reaches the threshold; ``only`` is a condition on ``l`` and ``r``."""
    left, right = _cell_sides(blocked, cfg)
    total = (
        f"{cfg.name_weight}D * {_best_text('name', cfg)} + {cfg.address_weight}D * {_best_text('address', cfg)}"
        f" + IF(l.city_hash = r.city_hash, {cfg.city_weight}D, 0D)"
        f" + IF(l.postal_hash = r.postal_hash AND l.postal_code IS NOT NULL, {cfg.postal_weight}D, 0D)"
    )
    once = "(l.place_kind <> 'postal' OR l.city_hash <> r.city_hash OR l.city_key <> r.city_key)"
    same_cell = " AND ".join(f"l.{c} = r.{c}" for c in _CELL)
    return left.alias("l").join(
        right.alias("r"),
        F.expr(
            f"{same_cell} AND l.source_rank < r.source_rank AND {total} >= {cfg.fuzzy_threshold - 1e-9}D AND {once} AND {only}"
        ),
    )


def _sided() -> list[Column]:
    return [F.col(f"{side}.{name}").alias(f"{name}_{suffix}") for side, suffix in (("l", "a"), ("r", "b")) for name in _SIDE]


def _dense_pairs(blocked: DataFrame, cfg: MasteringConfig, only: str) -> DataFrame:
    """Profile pairs of dense blocks with their raw score, a cell at a time; the cells hold a bounded number of rows a side."""
    left, right = _cell_sides(blocked, cfg)
    match = matched_in_cell(
        blocked.columns, cfg.name_weight, cfg.address_weight, cfg.city_weight, cfg.postal_weight, cfg.fuzzy_threshold, cfg.binarize_threshold)
    row = blocked.schema.simpleString()
    pairs = left.groupBy(*_CELL).cogroup(right.groupBy(*_CELL)).applyInArrow(match, f"l {row}, r {row}, raw double")
    return pairs.filter(F.expr(only)).select(*_sided(), "raw")


def scored_profile_pairs(blocked: DataFrame, cfg: MasteringConfig, only: str = "true") -> DataFrame:
    """Profile pairs that reach the threshold, with the score rounded to 4 places; ``only`` is a condition on the sides ``l`` and ``r``."""
    agree = lambda name: F.coalesce(F.col(f"{name}_a") == F.col(f"{name}_b"), F.lit(False))
    if _ignores_text(cfg):
        return _candidates(blocked, cfg, only).select(*_sided()).withColumn("score", _place_scores(cfg, agree("city_key"), agree("postal_code"))).filter(
            "score IS NOT NULL").select(*[f"{n}_{s}" for s in "ab" for n in _SIDE], "score")
    place = agree("city_key").cast("double") * cfg.city_weight + agree("postal_code").cast("double") * cfg.postal_weight
    paired = _candidates(blocked.filter("NOT dense"), cfg, only).select(*_sided(), F.expr(_best_text("address", cfg)).alias("address_best")).withColumn("place_part", place)
    similarity = weighted_similarity(cfg.name_weight, cfg.address_weight, cfg.fuzzy_threshold, cfg.binarize_threshold)
    sparse = paired.withColumn("raw", similarity("name_key_a", "name_key_b", "address_key_a", "address_key_b", "address_best", "place_part"))
    dense = _dense_pairs(blocked.filter("dense"), cfg, only)
    every = sparse.select(*dense.columns).unionByName(dense)
    return every.withColumn("total", F.round("raw", 10)).filter(F.col("total") >= cfg.fuzzy_threshold).select(
        *[f"{n}_{s}" for s in "ab" for n in _SIDE], F.round("total", 4).alias("score")
    )


def profile_members(parties: DataFrame, pairs: DataFrame, cfg: MasteringConfig) -> DataFrame:
    """(id, profile_id) of every record whose profile takes part in a match."""
    side = lambda s: pairs.select(*[F.col(f"{n}_{s}").alias(n) for n in _SIDE])
    return _records_of(parties, side("a").unionByName(side("b")), cfg)


def _records_of(parties: DataFrame, matched: DataFrame, cfg: MasteringConfig) -> DataFrame:
    """(id, profile_id) of the records of profiles, which may come several times.

    A profile of one record is its own member; only larger ones go back to the records.
    """
    alone = matched.filter("members = 1").select(F.col("profile_id").alias("id"), "profile_id").distinct()
    shared = matched.filter("members > 1").distinct()
    same = [F.col(f"c.{c}").eqNullSafe(F.col(f"s.{c}")) for c in _PROFILE]
    copies = _comparison_columns(parties, cfg).alias("c").join(shared.alias("s"), same).select("c.id", "s.profile_id")
    return alone.unionByName(copies)


def without_exact_pairs(pairs: DataFrame, member_of: DataFrame, exact: DataFrame) -> DataFrame:
    """Adds ``pairs``: record pairs of each profile pair that no identifier already joins.

    Counted from key sizes per profile; the profile with fewer records is the
    one expanded to its keys.
    """
    keys = (
        exact.select("id", *_KEY).join(member_of, "id").groupBy("profile_id", *_KEY).agg(F.count(F.lit(1)).alias("n"))
    )
    small_is_a = F.col("members_a") <= F.col("members_b")
    overlap = (
        pairs.select(
            "profile_id_a", "profile_id_b",
            F.when(small_is_a, F.col("profile_id_a")).otherwise(F.col("profile_id_b")).alias("small_id"),
            F.when(small_is_a, F.col("profile_id_b")).otherwise(F.col("profile_id_a")).alias("large_id"),
        )
        .join(keys.withColumnsRenamed({"profile_id": "small_id", "n": "n_small"}), "small_id")
        .join(keys.withColumnsRenamed({"profile_id": "large_id", "n": "n_large"}), ["large_id", *_KEY])
        .groupBy("profile_id_a", "profile_id_b")
        .agg(
            F.sum(
                F.when(F.col("match_type") == TAX_AND_LEI, F.lit(-1)).otherwise(F.lit(1)).cast("decimal(2,0)")
                * F.col("n_small").cast("decimal(17,0)")
                * F.col("n_large").cast("decimal(17,0)")
            ).alias("exact_pairs")
        )
    )
    every = F.col("members_a").cast("decimal(19,0)") * F.col("members_b").cast("decimal(19,0)")
    none = F.lit(0).cast("decimal(38,0)")
    narrow = pairs.select(*[f"{n}_{s}" for s in "ab" for n in ("profile_id", "source_system", "members")], "score")
    return (
        narrow.join(overlap, ["profile_id_a", "profile_id_b"], "left")
        .withColumn("pairs", (every - F.coalesce(F.col("exact_pairs"), none)).cast("decimal(38,0)"))
        .drop("exact_pairs")
        .filter("pairs > 0")
    )


# Places that two records of a match may agree on.
_AGREEMENTS = {
    (False, False): ("state",), (True, False): ("state", "city_key"), (False, True): ("state", "postal_code"), (True, True): ("state", "city_key", "postal_code"),
}


def _whole_blocks(cfg: MasteringConfig) -> list[tuple[str, ...]]:
    """Keys of the widest blocks of which every pair of two sources matches, where texts do not count."""
    whole = {agree: keys for agree, keys in _AGREEMENTS.items() if _place_score(cfg, *agree) is not None}
    if (False, False) in whole and not cfg.needs_place_agreement:
        return [whole[False, False]]
    narrower = [whole[agree] for agree in ((True, False), (False, True)) if agree in whole]
    return narrower or [keys for agree, keys in whole.items() if all(agree)]


def place_blocks(profile: DataFrame, cfg: MasteringConfig) -> DataFrame:
    """The profiles that match where texts do not count, once for each block that they match in.

    ``anchor`` is the block's smallest profile, ``firsts`` the smallest profile
    of each source. All pairs of two sources of such a block match, so it
    stands for them and nothing lists them.
    """
    def of(keys: tuple[str, ...]) -> DataFrame:
        rows = profile.filter(F.col("postal_code").isNotNull()) if "postal_code" in keys else profile
        first = rows.groupBy(*keys, "source_system").agg(F.min(F.struct("profile_id", "city_key", "postal_code")).alias("f"))
        blocks = first.groupBy(*keys).agg(
            F.min("f.profile_id").alias("anchor"), F.collect_list(F.struct("source_system", "f.*")).alias("firsts")).filter(F.size("firsts") > 1)
        return rows.join(blocks, list(keys)).select(*_SIDE, "anchor", "firsts")

    found = [of(keys) for keys in _whole_blocks(cfg)]
    nothing = lambda: profile.select(*_SIDE, F.col("profile_id").alias("anchor"), F.array(F.struct("source_system", "profile_id", "city_key", "postal_code")).alias("firsts")).filter("false")
    return reduce(DataFrame.unionByName, found) if found else nothing()


def _place_facts(parties: DataFrame, cfg: MasteringConfig) -> DataFrame:
    """:func:`fuzzy_facts` where texts do not count: from numbers of records a place and source, less the same a place, source and identifier.

    The pairs of a place are those that agree on it and maybe on more, so each
    kind of agreement is counted on its place, less what agrees on both places.
    """
    places = ["state", clean_key("city").alias("city_key"), "postal_code"]
    compared = parties.filter(_compared(cfg))
    every = compared.select("id", "source_system", *places, *[F.lit("").alias(c) for c in _KEY])
    counted = every.unionByName(_exact_keys(compared, *places)).groupBy(*_KEY, "source_system", *_AGREEMENTS[True, True]).agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("id"))
    sign = F.when(F.col("match_type").isin("", TAX_AND_LEI), 1).otherwise(-1).cast("decimal(2,0)")
    matching = {agree: score for agree in _AGREEMENTS if (score := _place_score(cfg, *agree)) is not None and (any(agree) or not cfg.needs_place_agreement)}

    def of(agree: tuple[bool, bool]) -> DataFrame | None:
        keys = [*_KEY, *_AGREEMENTS[agree]]
        # A pair of this place counts as such, and no more as one of a wider place.
        shares = [((-1) ** (sum(agree) - sum(wider)), score) for wider, score in matching.items() if all(w <= a for w, a in zip(wider, agree))]
        if not shares:
            return None
        rows = counted.filter(F.col("postal_code").isNotNull()) if agree[1] else counted
        n = F.col("n").cast("decimal(19,0)")
        sums = rows.groupBy(*keys, "source_system").agg(F.sum("n").alias("n"), F.min("id").alias("id")).groupBy(*keys).agg(
            F.sum(n).alias("all"), F.sum((n * n).cast("decimal(38,0)")).alias("own"), F.min("id").alias("id"))
        pairs = sums.withColumn("pairs", F.floor((F.col("all") * F.col("all") - F.col("own")) / 2).cast("decimal(38,0)")).filter("pairs > 0")
        return pairs.select(
            "id", (sign * F.col("pairs") * sum(times for times, _ in shares)).cast("decimal(38,0)").alias("pairs"),
            (sign.cast("double") * F.col("pairs").cast("double") * sum(times * score for times, score in shares)).alias("score"))

    none = counted.select("id", F.lit(0).cast("decimal(38,0)").alias("pairs"), F.lit(0.0).alias("score")).filter("false")
    return reduce(DataFrame.unionByName, [rows for agree in _AGREEMENTS if (rows := of(agree)) is not None], none)


@dataclass(frozen=True)
class Matches:
    """Everything the matching stage found, in factored form."""

    groups: DataFrame  # exact identifier groups
    members: DataFrame  # records of those groups
    member_of: DataFrame  # record -> matched profile
    listed: Callable[[], DataFrame]  # gives fuzzy
    blocks: DataFrame | None = None  # where texts do not count, the blocks that stand for the profile pairs
    facts: DataFrame | None = None  # and their counts

    @cached_property
    def fuzzy(self) -> DataFrame:
        """Profile pairs above the threshold, exact pairs taken out. Where texts do not count, they are all pairs of a block: a frame to be read once, written nowhere."""
        return self.listed()


def find_matches(parties: DataFrame, cfg: MasteringConfig, keep=lambda df, name: df) -> Matches:
    """Runs exact and fuzzy matching; ``keep(df, name)`` may write an intermediate table."""
    members = keep(exact_members(parties, exact_groups(parties)), "exact_members")
    groups = members.filter("id = anchor_id").withColumn("pairs", pair_count(F.col("members")))
    if _ignores_text(cfg):
        profile = keep(profiles(parties, cfg), "profiles")
        blocks = keep(place_blocks(profile, cfg), "place_blocks")
        member_of = keep(_records_of(parties, blocks.select(*_SIDE), cfg), "profile_members")
        return Matches(groups, members, member_of, lambda: _listed_in_blocks(profile, member_of, members, cfg, keep), blocks, _place_facts(parties, cfg))
    blocked = keep(blocked_profiles(profiles(parties, cfg), cfg), "blocked_profiles")
    scored = keep(scored_profile_pairs(blocked, cfg), "scored_pairs")
    member_of = keep(profile_members(parties, scored, cfg), "profile_members")
    fuzzy = keep(without_exact_pairs(scored, member_of, members), "fuzzy_pairs")
    return Matches(groups, members, member_of, lambda: fuzzy)


def _listed_in_blocks(profile: DataFrame, member_of: DataFrame, exact: DataFrame, cfg: MasteringConfig, keep) -> DataFrame:
    """All profile pairs of the blocks, straight from the join that makes them: they are as many as the blocks' squares, so no step shuffles or writes them.

    Only pairs of profiles that may have an identifier in common, by sets of 64
    bits, are looked up among the identifiers.
    """
    two_sources = exact.groupBy(*_KEY).agg(F.min("source_system").alias("low"), F.max("source_system").alias("high")).filter("low < high").select(*_KEY)
    bit = F.expr("shiftleft(1L, CAST(pmod(xxhash64(key_1, key_2), 64L) AS INT))")
    masks = exact.join(two_sources, _KEY).join(member_of, "id").groupBy("profile_id").agg(F.bit_or(bit).alias("key_mask"))
    marked = keep(blocked_profiles(profile, cfg).join(masks, "profile_id", "left").withColumn("key_mask", F.coalesce("key_mask", F.lit(0).cast("bigint"))), "blocked_profiles")
    common = "(l.key_mask & r.key_mask)"
    apart = scored_profile_pairs(marked, cfg, f"{common} = 0")
    scored = keep(scored_profile_pairs(marked.filter("key_mask <> 0"), cfg, f"{common} <> 0"), "scored_pairs")
    near = keep(without_exact_pairs(scored, member_of, exact), "fuzzy_pairs")
    few = lambda side: F.col(f"members_{side}") < 2**31
    wide = lambda side: F.col(f"members_{side}").cast("decimal(19,0)")
    number = F.when(few("a") & few("b"), (F.col("members_a") * F.col("members_b")).cast("decimal(38,0)")).otherwise((wide("a") * wide("b")).cast("decimal(38,0)"))
    return apart.withColumn("pairs", number).select(*near.columns).unionByName(near)


def alike_edges(matches: Matches) -> DataFrame:
    """(x, y): edges between matched profiles that connect what their pairs connect."""
    if matches.blocks is not None:
        return matches.blocks.select(F.col("profile_id").alias("x"), F.col("anchor").alias("y"))
    return matches.fuzzy.select(F.col("profile_id_a").alias("x"), F.col("profile_id_b").alias("y"))


def fuzzy_facts(matches: Matches) -> DataFrame:
    """(id, pairs, score): parts of the numbers of fuzzy pairs and of the sums of their scores, each at a record of its cluster."""
    if matches.facts is not None:
        return matches.facts
    return matches.fuzzy.select(F.col("profile_id_a").alias("id"), "pairs", (F.col("score") * F.col("pairs").cast("double")).alias("score"))


def first_partners(matches: Matches, cfg: MasteringConfig) -> DataFrame:
    """(anchor, partner): the profile that comes first, by source and id, among those a profile matches.

    In blocks that may be one with which all records share an identifier; then
    that identifier gives the same record, as an exact partner, which goes first.
    """
    partner = lambda source, profile_id, score: F.struct(source.alias("source_system"), profile_id.alias("id"), F.lit(1).alias("fuzzy"), score.alias("score"))
    if matches.blocks is not None:
        same = lambda f, name: F.coalesce(f[name] == F.col(name), F.lit(False))
        others = F.transform(
            F.filter("firsts", lambda f: f["source_system"] != F.col("source_system")),
            lambda f: partner(f["source_system"], f["profile_id"], _place_scores(cfg, same(f, "city_key"), same(f, "postal_code"))))
        found = matches.blocks.select(F.col("profile_id").alias("anchor"), F.array_min(others).alias("partner"))
    else:
        side = lambda me, other: matches.fuzzy.select(
            F.col(f"profile_id_{me}").alias("anchor"), partner(F.col(f"source_system_{other}"), F.col(f"profile_id_{other}"), F.col("score")).alias("partner"))
        found = side("a", "b").unionByName(side("b", "a"))
    return found.groupBy("anchor").agg(F.min("partner").alias("partner"))


def pair_label(cfg: MasteringConfig, left: str = "source_system_a", right: str = "source_system_b") -> Column:
    """Label such as ``CRM vs DNB`` of a compared source pair."""
    label = F.lit(None).cast("string")
    for a, b, text in cfg.source_pairs:
        label = F.when((F.col(left) == a) & (F.col(right) == b), text).otherwise(label)
    return label


def fuzzy_matches(matches: Matches, cfg: MasteringConfig) -> DataFrame:
    """Fuzzy matches, one row per pair of look-alike profiles.

    ``id_1``/``id_2`` are the smallest ids of the two profiles in ascending
    order; ``pairs`` is the number of record pairs the row stands for.
    """
    return matches.fuzzy.select(
        F.least("profile_id_a", "profile_id_b").alias("id_1"),
        F.greatest("profile_id_a", "profile_id_b").alias("id_2"),
        "score",
        F.lit(FUZZY_NAME_ADDRESS).alias("match_type"),
        pair_label(cfg).alias("source_pair"),
        "pairs",
    )


def match_edges(matches: Matches, cfg: MasteringConfig) -> DataFrame:
    """All match rows under their step, duplicates across steps kept.

    An exact group appears once per further member; a fuzzy row joins two profiles.
    """
    exact = matches.members.filter(
        (F.col("match_type") != TAX_AND_LEI) & (F.col("id") != F.col("anchor_id"))
    ).select(F.col("anchor_id").alias("id_1"), F.col("id").alias("id_2"), F.lit(1.0).alias("score"), "match_type")
    return exact.unionByName(fuzzy_matches(matches, cfg).select("id_1", "id_2", "score", "match_type"))


def match_counts(matches: Matches, cfg: MasteringConfig) -> DataFrame:
    """Pairs found per step: each identifier kind, then fuzzy per source pair."""
    exact = (
        matches.groups.filter(F.col("match_type") != TAX_AND_LEI)
        .groupBy("match_type").agg(F.sum("pairs").alias("pairs"))
        .select("match_type", F.lit("all").alias("source_pair"), "pairs")
    )
    fuzzy = (
        matches.fuzzy.groupBy(pair_label(cfg).alias("source_pair")).agg(F.sum("pairs").alias("pairs"))
        .select(F.lit(FUZZY_NAME_ADDRESS).alias("match_type"), "source_pair", "pairs")
    )
    return exact.unionByName(fuzzy)


def final_pair_types(matches: Matches) -> DataFrame:
    """Pairs per type once later steps have overwritten earlier ones (tax, then LEI, then fuzzy)."""
    counted = matches.groups.groupBy("match_type").agg(F.sum("pairs").alias("pairs"))
    kept = (
        counted.withColumn(
            "part",
            F.explode(
                F.when(
                    F.col("match_type") == TAX_AND_LEI,
                    F.array(F.struct(F.lit(TAX_ID_EXACT).alias("t"), (-F.col("pairs")).alias("p"))),
                ).otherwise(F.array(F.struct(F.col("match_type").alias("t"), F.col("pairs").alias("p"))))
            ),
        )
        .groupBy(F.col("part.t").alias("match_type")).agg(F.sum("part.p").alias("pairs"))
    )
    fuzzy = matches.fuzzy.agg(F.coalesce(F.sum("pairs"), F.lit(0).cast("decimal(38,0)")).alias("pairs")).select(
        F.lit(FUZZY_NAME_ADDRESS).alias("match_type"), "pairs"
    )
    return kept.unionByName(fuzzy).filter("pairs > 0")
