"""Who played, how long and where: clock intervals, position groups and positions handed on by substitutions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempoframe.functions.state import written

# Position codes of each group.
GROUPS = {
    "Defender": ("DC", "DL", "DR", "DCL", "DCR", "WB", "WBL", "WBR"),
    "Midfielder": ("DMC", "MC", "ML", "MR", "MCL", "MCR"),
    "Forward": ("AMC", "AML", "AMR", "FW", "FWL", "FWR", "ST", "CF"),
}
# Synonyms that a rating accepts.
SYNONYMS = {
    "Goalkeeper": ("goalkeeper", "gk"),
    "Defender": ("defender", "def", "d"),
    "Midfielder": ("midfielder", "mid", "m"),
    "Forward": ("forward", "fwd", "fw", "f"),
}
LONGEST = 130


def position_group(code: Column, variant: str = "strict") -> Column:
    """Group of a position code.

    ``strict`` knows the codes alone and says Unknown else; ``lenient`` also takes group names and first letters and is null for
    bench players and unknown codes; ``synonym`` reads spelled-out positions.
    """
    plain = F.trim(F.coalesce(code.cast("string"), F.lit("")))
    if variant == "synonym":
        low = F.lower(plain)
        found = F.when(low.isin(*SYNONYMS["Goalkeeper"]), "Goalkeeper")
        for group in GROUPS:
            found = found.when(low.isin(*SYNONYMS[group]), group)
        return found.otherwise("Unknown")
    up = F.upper(plain)
    found = F.when(up.startswith("GK"), "Goalkeeper")
    for group, codes in GROUPS.items():
        found = found.when(up.isin(*codes), group)
    if variant == "strict":
        return found.otherwise("Unknown")
    if variant != "lenient":
        raise ValueError(f"no such variant: {variant}")
    named = F.when(plain.isin("Goalkeeper", *GROUPS), plain).when(up.isin("", "SUB"), F.lit(None).cast("string"))
    first = F.left(up, F.lit(1))
    guess = F.when(first == "D", "Defender").when(first == "M", "Midfielder").when(first.isin("F", "W"), "Forward")
    return F.when(plain.isin("Goalkeeper", *GROUPS) | up.isin("", "SUB"), named).otherwise(F.coalesce(F.when(found.isNotNull(), found), guess))


def match_ends(events: DataFrame) -> DataFrame:
    """Last minute of each match: 120 if it went past minute 105 or into extra time, else 90."""
    extra = F.col("period_value").isin(3, 4)
    if "period_name" in events.columns:
        extra = extra | F.lower("period_name").contains("extra")
    late = (F.max("minute") > 105) | F.coalesce(F.bool_or(extra), F.lit(False))
    return events.groupBy("match_id").agg(F.when(late, 120).otherwise(90).alias("match_end"))


def appearance_minutes(lineups: DataFrame, events: DataFrame, substitutions: DataFrame) -> DataFrame:
    """Lineup rows with ``minutes`` and their ``minutes_source``.

    ``events`` has ``match_id, player_id, minute, period_value, card_type``, ``substitutions`` has ``match_id, player_id, related_player_id,
    type_name, event_minute``. Positive minutes of the provider stand. Otherwise a player who started, came on, went off or acted
    played from zero, from coming on, from the first action or not at all, to the substitution or dismissal or the end, at least one minute and at most 130.
    """
    key = ["match_id", "player_id"]
    on_kind = F.col("type_name") == "SubstitutionOn"
    both = substitutions.where(F.col("type_name").isin("SubstitutionOn", "SubstitutionOff"))
    roles = both.select("match_id", "event_minute", F.inline(F.array(
        F.struct(F.when(on_kind, F.col("player_id")).otherwise(F.col("related_player_id")).alias("player_id"), F.lit("on").alias("role")),
        F.struct(F.when(on_kind, F.col("related_player_id")).otherwise(F.col("player_id")).alias("player_id"), F.lit("off").alias("role")),
    ))).dropna(subset=["player_id"])
    sent = events.where(F.regexp_replace(F.lower("card_type"), "[^a-z]", "").rlike("red|secondyellow")).select(
        "match_id", F.col("minute").alias("event_minute"), "player_id", F.lit("off").alias("role")
    )
    turns = roles.unionByName(sent).groupBy(*key).agg(
        F.min(F.when(F.col("role") == "on", F.col("event_minute"))).alias("on_minute"),
        F.min(F.when(F.col("role") == "off", F.col("event_minute"))).alias("off_minute"),
    )
    acted = events.dropna(subset=key).groupBy(*key).agg(F.min("minute").alias("first_minute"))
    rows = lineups.join(turns, key, "left").join(acted, key, "left").join(match_ends(events), "match_id", "left")
    end = F.coalesce("match_end", F.lit(90))
    started = F.coalesce(F.col("started").cast("int"), F.lit(0)) == 1
    took_part = started | F.col("on_minute").isNotNull() | F.col("off_minute").isNotNull() | F.col("first_minute").isNotNull()
    begin = F.when(started, 0).otherwise(F.coalesce("on_minute", "first_minute", end))
    played = F.least(F.greatest(F.coalesce("off_minute", end) - begin, F.lit(1)), F.lit(LONGEST)).cast("double")
    given = F.coalesce(F.col("minutes") > 0, F.lit(False))
    return rows.withColumns(
        {
            "minutes_source": F.when(given, "provider").when(took_part, "derived_lineup_events").otherwise("not_played"),
            "minutes": F.when(given, F.col("minutes")).when(took_part, played).otherwise(0.0),
        }
    ).drop("on_minute", "off_minute", "first_minute", "match_end")


def propagate_positions(lineups: DataFrame, substitutions: DataFrame, group: str = "position_group", max_rounds: int = 50) -> DataFrame:
    """Substitutes without a group take that of the player they replaced, along chains.

    A player replaced several others in turn takes the smallest known group. Each round hands the groups of the last one a step on, to players that
    have none yet; only these and their substitutions are written in a round, and lineups are joined once, at the end.
    """
    key = ["match_id", "player_id"]
    came = F.col("type_name") == "SubstitutionOn"
    pairs = substitutions.where(F.col("type_name").isin("SubstitutionOn", "SubstitutionOff")).select(
        "match_id",
        F.when(came, F.col("player_id")).otherwise(F.col("related_player_id")).alias("player_id"),
        F.when(came, F.col("related_player_id")).otherwise(F.col("player_id")).alias("replaced_id"),
    ).dropna().distinct()
    unknown = lineups.where(F.col(group).isNull()).select(*key).distinct()
    pairs = written(pairs.join(unknown, key, "left_semi"), "pairs")
    known = lineups.where(F.col(group).isNotNull()).select("match_id", F.col("player_id").alias("replaced_id"), F.col(group).alias("_given"))
    last = written(pairs.join(known, ["match_id", "replaced_id"]).groupBy(*key).agg(F.min("_given").alias("_given")), "given")
    found = last
    for _ in range(max_rounds):
        if last.isEmpty():
            return lineups.join(found, key, "left").withColumn(group, F.coalesce(group, "_given")).select(*lineups.columns)
        step = last.withColumnRenamed("player_id", "replaced_id")
        rest = pairs.join(found.select(*key), key, "left_anti")
        last = written(rest.join(step, ["match_id", "replaced_id"]).groupBy(*key).agg(F.min("_given").alias("_given")), "given")
        found = found.unionByName(last)
    raise RuntimeError(f"positions did not settle in {max_rounds} rounds")
