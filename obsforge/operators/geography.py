"""Geography get-or-create as set operations.

Loading record by record, each request looks for a member that agrees with
what its level lets it ask for, and failing that tries to insert one, which
fails on a code that is taken. The outcome depends on order, yet has an exact
set form:

* what a request may match is fixed by one *lookup key* (its code if it has
  one, else its names), and
* a request creates a member at most once, at its first insertable record; only
  a metro, which never looks for anything, inserts with each record.

Whether a distinct request inserts depends on earlier ones alone. So all that
the table doesn't serve are taken to insert, and rounds of two joins over the distinct requests correct
that from what the last round left, until a round changes nothing: decisions
settle from the first record on, and rarely hang on more than one another.

Every record finds its member through one equi-join on the lookup key. ``born``
is the position of a member's first record; members already in the table are
born before every record. A record sees only members born no later than itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsforge.operators.constraints import LEVELS, geography_reason
from obsforge.operators.dimensions import new_id
from obsforge.schema import GEOGRAPHY
from obsforge.session import staged

_BEFORE_ALL = -(1 << 62)
_KEY = ("level", "state", "county", "fips_code")
_MEMBER = ("id", "level", "state", "state_name", "county", "fips_code", "born")


def _given(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(""))


def requests_of(observations: DataFrame, order_by: str) -> DataFrame:
    """Geography request of every observation, empty texts as NULL."""
    return observations.select(
        F.col(order_by).alias("idx"),
        F.col("geography_level").alias("level"),
        _given("state").alias("state"),
        F.col("state_name"),
        _given("county").alias("county"),
        _given("fips_code").alias("fips_code"),
    )


def has_a_form(level: str = "level") -> Column:
    """Whether the level of a request goes with its place: a known one, a nation without and others with a state.

    A county may leave its state to the member that it asks for.
    """
    at = F.col(level)
    named = (at == "county") | ((at == "nation") == F.col("state").isNull())
    return F.coalesce(at.isin(*LEVELS) & named, F.lit(False))


def _known_members(existing: DataFrame) -> DataFrame:
    return existing.select(
        "id", "level", "state", "state_name", "county", "fips_code",
        (F.col("id") + F.lit(_BEFORE_ALL)).alias("born"),
    )


def _candidates(requests: DataFrame) -> DataFrame:
    """Distinct insertable requests with their first record and its state name.

    Grouped with the name first: a name rarely varies, and smallest positions are kept in hashed rows.
    """
    insertable = requests.where(geography_reason().isNull())
    named = insertable.groupBy(*_KEY, "state_name").agg(F.min("idx").alias("born"))
    return named.groupBy(*_KEY).agg(F.min_by("state_name", "born").alias("state_name"), F.min("born").alias("born"))


def _first_per(df: DataFrame, *keys: str) -> DataFrame:
    row = F.struct("level", "state", "state_name", "county", "fips_code", "born")
    return df.groupBy(*keys).agg(F.min_by(row, "born").alias("_row")).select("_row.*")


def _unless_earlier(candidates: DataFrame, members: DataFrame, *keys: str) -> DataFrame:
    """Candidates without a member of the same key born before them."""
    earliest = members.groupBy(*keys).agg(F.min("born").alias("_earliest"))
    joined = candidates.join(earliest, list(keys), "left")
    fresh = joined.where(F.col("_earliest").isNull() | (F.col("born") < F.col("_earliest")))
    return fresh.select(*candidates.columns)


def new_geographies(
    requests: DataFrame, existing: DataFrame, at: Column, base: int | None = None
) -> DataFrame:
    """Geography rows the requests add to ``existing``, with ``born``."""
    known = _known_members(existing)
    # at first all insert that nothing in the table serves
    start = _candidates(requests).withColumn("inserts", F.lit(True))
    # read many times by a round: keep the distinct requests, not the records
    wanted = staged(_decide(start, _lookup(known)).drop("before"), "geography-candidates")
    while True:
        # two rounds at a time: each staged table costs more than a round
        first = _decide(wanted, _lookup(_members(known, wanted))).drop("before")
        decided = staged(_decide(first, _lookup(_members(known, first))), "geography-candidates")
        wanted = decided.drop("before")
        if decided.where(F.col("inserts") != F.col("before")).isEmpty():
            break
    free_metro = (F.col("level") == "metro") & F.col("fips_code").isNull()
    each = requests.where(free_metro & geography_reason().isNull()).withColumnRenamed("idx", "born")
    columns = [*_KEY, "state_name", "born"]
    created = wanted.where(F.col("inserts") & ~free_metro).select(*columns).unionByName(each.select(*columns))
    return _as_rows(created, existing, at, base)


def _members(known: DataFrame, wanted: DataFrame) -> DataFrame:
    return known.unionByName(wanted.where("inserts").drop("inserts"), allowMissingColumns=True)


def _decide(wanted: DataFrame, earliest: DataFrame) -> DataFrame:
    """Whether each distinct request inserts, given the earliest members under every key; ``before`` is the last answer."""
    found = resolve_geography(wanted, earliest.where("geo_kind <> 'own'"), "born", keep_member=True)
    holders = earliest.where("geo_kind = 'code'").select(
        F.col("geo_first").alias("_code"), F.col("geo_member.born").alias("_taken")
    )
    joined = found.withColumnRenamed("inserts", "before").join(holders, F.col("fips_code") == F.col("_code"), "left")
    served = F.coalesce(F.col("geo_member.born") < F.col("born"), F.lit(False))
    taken = F.coalesce(F.col("_taken") < F.col("born"), F.lit(False))
    return joined.select(*_KEY, "state_name", "born", "before", (~served & ~taken).alias("inserts"))


def _as_rows(members: DataFrame, existing: DataFrame, at: Column, base: int | None = None) -> DataFrame:
    rows = members.select(
        new_id(existing, F.col("born"), base).alias("id"),
        F.lit("USA").alias("country"),
        "state",
        "state_name",
        "county",
        "fips_code",
        "level",
        F.lit(None).cast("string").alias("region"),
        at.alias("created_at"),
        F.col("born"),
    )
    return rows.select(
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in GEOGRAPHY.fields), "born"
    )


# Lookup keys: kind of match, then up to two texts.
def _lookup_key(kind: str, first: Column | None = None, second: Column | None = None) -> Column:
    empty = F.lit("")
    return F.struct(
        F.lit(kind).alias("kind"),
        (empty if first is None else first).alias("first"),
        (empty if second is None else second).alias("second"),
    )


def _short_code() -> Column:
    """A state's request asks only for codes of two characters."""
    return F.coalesce(F.length("fips_code") == 2, F.lit(False))


def request_key(order_by: str, level_name: str = "level") -> Column:
    """Lookup key of a request; NULL when it specifies nothing to look for."""
    level, state = F.col(level_name), F.col("state")
    county, code = F.col("county"), F.col("fips_code")
    return (
        F.when(level == "nation", _lookup_key("nation"))
        .when(level == "metro", _lookup_key("own", F.col(order_by).cast("string")))
        .when(
            level == "state",
            F.when(_short_code(), _lookup_key("code", code)).when(state.isNotNull(), _lookup_key("state", state)),
        )
        .when(
            level == "county",
            F.when(code.isNotNull(), _lookup_key("code", code))
            .when(state.isNotNull() & county.isNotNull(), _lookup_key("county", state, county))
            .when(county.isNotNull(), _lookup_key("name", county))
            .when(state.isNotNull(), _lookup_key("within", state)),
        )
    )


def _lookup(members: DataFrame) -> DataFrame:
    """Earliest member under every lookup key, a few rows per member."""
    level, state = F.col("level"), F.col("state")
    county, code, born = F.col("county"), F.col("fips_code"), F.col("born")
    keys = F.array_compact(
        F.array(
            F.when((level == "nation") & state.isNull(), _lookup_key("nation")),
            F.when((level == "metro") & (born >= 0), _lookup_key("own", born.cast("string"))),
            F.when(code.isNotNull(), _lookup_key("code", code)),
            F.when((level == "state") & state.isNotNull(), _lookup_key("state", state)),
            F.when(state.isNotNull() & county.isNotNull(), _lookup_key("county", state, county)),
            F.when(county.isNotNull(), _lookup_key("name", county)),
            F.when(state.isNotNull(), _lookup_key("within", state)),
        )
    )
    member = F.struct("id", "level", "state", "county", "born")
    return (
        members.select(F.explode(keys).alias("k"), member.alias("member"))
        .groupBy(
            F.col("k.kind").alias("geo_kind"),
            F.col("k.first").alias("geo_first"),
            F.col("k.second").alias("geo_second"),
        )
        .agg(F.min_by("member", F.col("member.born")).alias("geo_member"))
    )


def geography_lookup(existing: DataFrame, created: DataFrame) -> DataFrame:
    """Earliest member under every lookup key, of those there were and those the load adds."""
    return _lookup(_known_members(existing).unionByName(created.select(*_MEMBER)))


def resolve_geography(
    requests: DataFrame, lookup: DataFrame, order_by: str = "idx", level: str = "level", keep_member: bool = False
) -> DataFrame:
    """Add ``geography_id`` to every request; NULL where no member can serve it.

    One equi-join. Spark broadcasts the lookup when it measures it small and
    else shuffles both sides, splitting hot keys. ``keep_member`` adds the member
    itself as ``geo_member``.
    """
    key = request_key(order_by, level)
    keyed = requests.select(
        "*",
        F.coalesce(key["kind"], F.lit("none")).alias("geo_kind"),
        # requests without a key match nothing: spread them instead of piling them up
        F.coalesce(key["first"], F.col(order_by).cast("string")).alias("geo_first"),
        F.coalesce(key["second"], F.lit("")).alias("geo_second"),
    )
    joined = keyed.join(lookup, ["geo_kind", "geo_first", "geo_second"], "left")
    member = F.col("geo_member")
    by_code, own = F.col("geo_kind") == "code", F.col(level)
    given_state = F.col("state").isNotNull()
    level_fits = (own != "state") | ~given_state | (member["level"] == "state")
    state_fits = ~given_state | (F.col("state") == member["state"])
    county_fits = (own != "county") | F.col("county").isNull() | (F.col("county") == member["county"])
    serves = (~by_code | (level_fits & state_fits & county_fits)) & (member["born"] <= F.col(order_by))
    kept = [F.when(serves, member).alias("geo_member")] if keep_member else []
    return joined.select(*requests.columns, F.when(serves, member["id"]).alias("geography_id"), *kept)


def new_geographies_strict(requests: DataFrame, existing: DataFrame, at: Column) -> DataFrame:
    """Rows added under the strict match: state, county and any code must all agree.

    Here an absent county only matches an absent county, the level is not
    compared, and a request without a state matches nothing, so each one
    inserts (or fails on a code that is taken).
    """
    insertable = requests.where(geography_reason().isNull())
    wanted = insertable.groupBy(*_KEY).agg(
        F.min("idx").alias("born"), F.min_by("state_name", "idx").alias("state_name")
    )
    wanted = staged(wanted, "geography-candidates")
    columns = ["level", "state", "state_name", "county", "fips_code", "born"]
    held = existing.where(F.col("fips_code").isNotNull()).select("fips_code")
    free = wanted.where(F.col("fips_code").isNotNull()).join(held, "fips_code", "left_anti")
    coded = _first_per(free, "fips_code")
    members = _known_members(existing).unionByName(coded, allowMissingColumns=True)

    # within one (state, county), the first request without a code is the only new one
    place = ("_state", "_county")
    spelled = {"_state": F.col("state"), "_county": F.coalesce("county", F.lit("\x00"))}
    uncoded = wanted.where(F.col("fips_code").isNull() & F.col("state").isNotNull())
    first = _first_per(uncoded.withColumns(spelled), *place)
    named = _unless_earlier(
        first.withColumns(spelled),
        members.where(F.col("state").isNotNull()).withColumns(spelled),
        *place,
    )
    stateless = insertable.where(F.col("state").isNull() & F.col("fips_code").isNull())
    each = stateless.withColumn("born", F.col("idx"))
    created = coded.select(*columns).unionByName(named.select(*columns)).unionByName(
        each.select(*columns)
    )
    return _as_rows(created, existing, at)
