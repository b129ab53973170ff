"""Comparing one side's rates with the other side's distribution, pair by pair, and across entities.

A rate row has system, facility (left side only), code, code_type, carrier, plan, setting, billing_class, product_class, rate,
rate_kind, methodology (a family) and vintage (a date).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratesmith.functions import numbers as N
from ratesmith.functions import text as X
from ratesmith.rules import tables as T
from ratesmith.sources import lake

from . import sweeps

LEFT = ["system", "facility", "code", "code_type", "carrier", "plan", "setting", "billing_class", "product_class", "rate", "rate_kind", "methodology", "vintage"]
RIGHT = [c for c in LEFT if c != "facility"]


def exempt(c: Column) -> Column:
    return F.coalesce(c.isin(T.EXEMPT_PRODUCTS), F.lit(False))


def refusal(left: str, right: str, days: int = T.VINTAGE_DAYS, across: bool = True) -> Column:
    """Why rows with prefixes `left` and `right` can't be compared, first reason first; null if they can."""
    a, b = (lambda c, p=p: F.col(p + c) for p in (left, right))
    family = X.code_family(a("code_type")) != X.code_family(b("code_type"))
    checks = [
        ("different_code", X.unpadded(a("code")) != X.unpadded(b("code"))),
        ("different_code_type", family),
        ("different_setting", X.differs(X.setting_key(a("setting")), X.setting_key(b("setting")))),
        ("different_billing_class", X.differs(a("billing_class"), b("billing_class"))),
    ]
    if across:
        checks += [
            ("tic_exempt_product", exempt(a("product_class")) | exempt(b("product_class"))),
            ("billing_class_unstated", (X.folded(a("billing_class")) == "") | (X.folded(b("billing_class")) == "")),
        ]
    dollars = (a("rate_kind") == "dollar") & (b("rate_kind") == "dollar")
    checks += [
        ("mixed_rate_kind", ~dollars & (a("rate_kind") != b("rate_kind"))),
        ("not_dollar_denominated", ~dollars),
        ("missing_rate", a("rate").isNull() | b("rate").isNull()),
        ("zero_rate", (a("rate") <= 0) | (b("rate") <= 0)),
        ("incompatible_methodology", ~(a("methodology").isin(T.COMPARABLE_METHODOLOGIES) & b("methodology").isin(T.COMPARABLE_METHODOLOGIES))),
        ("vintage_too_far_apart", N.days_apart(a("vintage"), b("vintage")) > days),
    ]
    return F.coalesce(*(F.when(test, F.lit(reason)) for reason, test in checks))


def _met(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Rows of both sides on system, code, carrier and setting. A left row asks its own bucket and the one that meets any; a
    blank left row asks only the latter. The right side is never copied."""
    key = X.setting_key(F.col("l_setting"))
    asked = F.when(key == "", F.array(F.lit(""))).otherwise(F.array(key, F.lit("")))
    lx = left.select(*(F.col(c).alias(f"l_{c}") for c in left.columns)).withColumn("_bucket", F.explode(asked))
    rx = right.select(*(F.col(c).alias(f"r_{c}") for c in right.columns)).withColumn("_key", X.setting_key(F.col("r_setting")))
    on = (F.col("l_system") == F.col("r_system")) & (X.code_key(F.col("l_code")) == X.code_key(F.col("r_code"))) & (X.folded(F.col("l_carrier")) == X.folded(F.col("r_carrier"))) & (F.col("_bucket") == F.col("_key"))
    return lx.join(rx, on, how).drop("_bucket", "_key")


def pair_join(left: DataFrame, right: DataFrame, days: int = T.VINTAGE_DAYS) -> DataFrame:
    """All pairs that share system, code, carrier and setting, with the reason for which each is refused, if it is."""
    return _met(left, right, "inner").withColumn("refusal", refusal("l_", "r_", days))


def pair_verdicts(left: DataFrame, right: DataFrame, by: list[str], days: int = T.VINTAGE_DAYS) -> DataFrame:
    """How many pairs of pair_join have each verdict, a refusal's name or `comparable`, by columns of the left side: by, verdict, pairs.

    No pair is made: rows of one spelling are counted together, and how many payer rates are near enough in time is a sweep's count."""
    left, right, kinds, payer = _written(left.where(F.col("system").isNotNull()), right)
    each = _profile_pairs(kinds, payer).groupBy(*_SPELLING, F.coalesce("_reason", F.lit("comparable")).alias("verdict")).agg(F.sum("r_rows").alias("_pairs"))
    rows = left.groupBy(*by, *_SPELLING).agg(F.count("*").alias("_rows"))
    verdicts = rows.join(each, _SPELLING).groupBy(*by, "verdict").agg(F.sum(F.col("_rows") * F.col("_pairs")).alias("pairs"))
    near = left.groupBy(*by, *_SWEPT).agg(F.count("*").alias("_rows"))
    near = near.join(_swept(left, right, kinds, payer, days, counts=True), _SWEPT).groupBy(*by).agg(F.sum(F.col("_rows") * F.col("n")).alias("_near"))
    near = near.select(*(F.col(c).alias(f"_by_{c}") for c in by), "_near")
    same = reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by))
    close = verdicts.where("verdict = 'comparable'").join(near, same, "left").withColumn("_near", F.coalesce("_near", F.lit(0)))
    both = F.array(F.struct(F.lit("comparable").alias("verdict"), F.col("_near").alias("pairs")), F.struct(F.lit("vintage_too_far_apart").alias("verdict"), (F.col("pairs") - F.col("_near")).alias("pairs")))
    return verdicts.where("verdict <> 'comparable'").unionByName(close.select(*by, F.inline(both)).where("pairs > 0"))


def _fingerprint(columns: list[Column], names: list[str]) -> dict[str, Column]:
    """Two hashes that tell rows apart, nulls included."""
    nulls = [c.isNull() for c in columns]
    return dict(zip(names, (F.xxhash64(*columns, *nulls), F.xxhash64(F.lit(1), *columns, *nulls)), strict=True))


def _spelt() -> dict[str, Column]:
    """What a row's profile is made of, as it is spelt. Rows have few spellings: what takes functions of texts is found for these."""
    rate = F.when(F.col("rate").isNull(), None).when(F.col("rate") <= 0, 0.0).otherwise(1.0)
    return {c: F.col(c) for c in RIGHT if c not in ("plan", "vintage")} | {"product_class": F.when(exempt(F.col("product_class")), T.EXEMPT_PRODUCTS[0]), "rate": rate, "_undated": F.col("vintage").isNull()}


def _profile() -> dict[str, Column]:
    """What of a rate row decides which rows it meets and why they are refused, but for the vintage; of the rate only whether it is
    missing or not over zero, of the product whether it is exempt."""
    return {
        "system": F.col("system"), "code": X.code_key(F.col("code")), "code_type": F.col("code_type"), "carrier": X.folded(F.col("carrier")), "setting": X.setting_key(F.col("setting")), "billing_class": X.folded(F.col("billing_class")),
        "product_class": F.when(exempt(F.col("product_class")), T.EXEMPT_PRODUCTS[0]), "rate": F.when(F.col("rate").isNull(), None).when(F.col("rate") <= 0, 0.0).otherwise(1.0), "rate_kind": F.col("rate_kind"), "methodology": F.col("methodology"),
    }


_ASKED = [f"q_{c}" for c in RIGHT if c not in ("plan", "vintage")]
#: A spelling's fingerprint, and what a sweep answers: a spelling's day.
_SPELLING = ["_s1", "_s2"]
_SWEPT = [*_SPELLING, "_at"]
#: A bucket's fingerprint.
_BUCKET = ["_b1", "_b2"]
#: The day of a payer rate that every question of its bucket sees.
_ALWAYS = -(2**40)


def _usable(prefix: str = "q_") -> Column:
    """Whether a row of that profile can be compared with another: pairs of such rows are refused for their vintages or families of
    codes alone, and all other pairs are refused. A kind or methodology that isn't known refuses nothing, as in `refusal`."""
    c = lambda name: F.col(prefix + name)
    known = F.coalesce(c("rate_kind") == "dollar", F.lit(True)) & F.coalesce(c("methodology").isin(T.COMPARABLE_METHODOLOGIES), F.lit(True))
    return known & c("product_class").isNull() & (c("billing_class") != "") & F.coalesce(c("rate") > 0, F.lit(False))


def _day() -> Column:
    return F.datediff("vintage", F.lit("1970-01-01").cast("date")).cast("long")


def _kinds(rows: DataFrame) -> DataFrame:
    """The spellings of rows with their profile under q_ names, the number of rows, and the bucket that a usable one asks."""
    spelt = rows.groupBy(*_SPELLING, *(c.alias(k) for k, c in _spelt().items())).agg(F.count("*").alias("_rows"))
    kinds = spelt.select(*_SPELLING, "_rows", "_undated", *(c.alias(f"q_{k}") for k, c in _profile().items())).withColumn("_family", X.code_family(F.col("q_code_type")))
    bucket = _fingerprint([F.col(c) for c in ("q_system", "q_code", "q_carrier", "q_setting", "q_billing_class", "_family", "_undated")], _BUCKET)
    return kinds.withColumns({k: F.when(_usable(), c) for k, c in bucket.items()})


def _table(df: DataFrame, name: str) -> DataFrame:
    return df.sparkSession.read.parquet(lake.working_table(df, name))


def _written(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Both sides with their spellings' fingerprints and days, and the kinds of both, from working tables: each is read several times and
    may be costly to make."""
    marks = {**_fingerprint(list(_spelt().values()), _SPELLING), "_at": F.coalesce(_day(), F.lit(0))}
    left, right = _table(left.withColumns(marks), "asking"), _table(right.withColumns(marks), "asked")
    return left, right, _table(_kinds(left), "kinds"), _table(_kinds(right), "payer_kinds")


def _profile_pairs(kinds: DataFrame, payer: DataFrame) -> DataFrame:
    """Spellings of the left side and profiles of the payer's that meet, with the number of payer rows (r_rows), whether the classes are
    one (_like) and the reason for a refusal whatever the vintages."""
    named = lambda rows: rows.withColumns({"plan": F.lit(None).cast("string"), "vintage": F.lit(None).cast("date")})
    plain = [F.col(c).alias(c.removeprefix("q_")) for c in _ASKED]
    p = _met(named(kinds.select(*_SPELLING, *plain)), named(payer.groupBy(*plain).agg(F.sum("_rows").alias("rows"))), "inner")
    like = F.col("l_billing_class") == F.col("r_billing_class")
    return p.select(*(F.col(f"l_{c}").alias(c) for c in _SPELLING), "r_rows", like.alias("_like"), refusal("l_", "r_").alias("_reason"))


def _swept(left: DataFrame, right: DataFrame, kinds: DataFrame, payer: DataFrame, days: int, counts: bool = False) -> DataFrame:
    """For each spelling and day that usable left rows ask about, the payer rates within `days`: _s1, _s2, _at, n, payer_min, payer_median,
    payer_max, networks, plan, day and product of the rate nearest to the median; counts: no more than n. Days without any have no row.

    A payer row goes to the buckets that ask for it: its setting, or every one if it is for all, and its family of codes. Which these are
    is found for spellings, not for rows. Rows of a bucket pass a task in the order of days, which holds those of the current days, so
    work follows the rows and not their pairs."""
    usable = kinds.where("_b1 IS NOT NULL")
    buckets = usable.select("q_system", "q_code", "q_carrier", "q_billing_class", "q_setting", "_family", "_undated", *_BUCKET).distinct()
    r = payer.select(*_SPELLING, *(F.col(c).alias(c.replace("q_", "r_")) for c in _ASKED), F.col("_family").alias("r_family")).where(_usable("r_"))
    meets = reduce(lambda x, y: x & y, (F.col(f"q_{c}") == F.col(f"r_{c}") for c in ("system", "code", "carrier", "billing_class")))
    meets &= F.col("r_setting").isin(F.lit(""), F.col("q_setting")) & F.coalesce(F.col("r_family") == F.col("_family"), F.lit(True))
    goes = r.join(buckets, meets).select(*_SPELLING, *_BUCKET, "_undated")
    enters = F.when(F.col("_undated") | F.col("vintage").isNull(), F.lit(_ALWAYS)).otherwise(F.col("_at") - days)
    null = lambda kind: F.lit(None).cast(kind)
    entering = right.join(goes, _SPELLING).select(*_BUCKET, enters.alias("_at"), F.lit(False).alias("asks"), *(null("long").alias(c) for c in _SPELLING), F.col("rate").cast("double").alias("rate"), "plan", _day().alias("day"), F.col("product_class").alias("product"))
    asking = left.select(*_SWEPT).distinct().join(usable.select(*_SPELLING, *_BUCKET), _SPELLING)
    asking = asking.select(*_BUCKET, "_at", F.lit(True).alias("asks"), *_SPELLING, null("double").alias("rate"), null("string").alias("plan"), null("long").alias("day"), null("string").alias("product"))
    if counts:
        w = Window.partitionBy(*_BUCKET).orderBy("_at", "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        lost = entering.where(F.col("_at") != _ALWAYS).select(*_BUCKET, (F.col("_at") + 2 * days + 1).alias("_at"), F.lit(-1).alias("change"))
        changes = entering.select(*_BUCKET, "_at", F.lit(1).alias("change")).unionByName(lost).groupBy(*_BUCKET, "_at").agg(F.sum("change").alias("change"))
        steps = changes.withColumns({"asks": F.lit(False), **{c: null("long") for c in _SPELLING}}).unionByName(asking.select(*_BUCKET, "_at", F.lit(0).cast("long").alias("change"), "asks", *_SPELLING))
        return steps.withColumn("n", F.sum("change").over(w)).where("asks AND n > 0").select(*_SWEPT, "n")
    rows = entering.unionByName(asking)
    return rows.repartition(*_BUCKET).sortWithinPartitions(*_BUCKET, "_at", "asks").mapInArrow(sweeps.spreads(days, _ALWAYS), sweeps.SPREAD)


def _refused(kinds: DataFrame, payer: DataFrame) -> DataFrame:
    """What becomes of a spelling's rows that have no rate near enough in time: _s1, _s2, refused. A table: it is small, and its size is
    known before the rows are joined."""
    p = _profile_pairs(kinds.where("q_product_class IS NULL"), payer)
    alike = lambda test: F.coalesce(F.sum(F.when(F.col("_like") & test, F.col("r_rows"))), F.lit(0))
    tests = {reason: F.col("_reason") == reason for reason in T.REFUSALS[:-1]} | {T.REFUSALS[-1]: F.col("_reason").isNull()}
    met = p.groupBy(*_SPELLING).agg(F.sum("r_rows").alias("_n_any"), alike(F.lit(True)).alias("_n_like"), *(alike(test).alias(f"_n_{reason}") for reason, test in tests.items()))
    most = F.greatest(*(F.col(f"_n_{reason}") for reason in T.REFUSALS))
    majority = F.coalesce(*(F.when(F.col(f"_n_{reason}") == most, F.lit(reason)) for reason in T.REFUSALS))
    refused = F.when(F.col("q_product_class").isNotNull(), "tic_exempt_product").when(F.col("_n_any").isNull(), T.NO_COUNTERPART)
    refused = refused.when(F.col("q_billing_class") == "", "billing_class_unstated").when(F.col("_n_like") == 0, "different_billing_class").otherwise(majority)
    return _table(kinds.join(met, _SPELLING, "left").select(*_SPELLING, refused.alias("refused")), "refused")


def distribution_join(left: DataFrame, right: DataFrame, days: int = T.VINTAGE_DAYS, assumed: Column | None = None) -> DataFrame:
    """One row for each left row: outcome and the comparable payer rates' spread.

    assumed: for which left rows a missing billing class is read as facility. outcome is `compared`, a refusal's name, or no
    counterpart. A compared row has n, payer_min, payer_median, payer_max, networks, and the network and vintage of the rate
    nearest to the median. No pairs of rates are made. Why rows are refused is counted by pairs of spellings and profiles (all that
    matters but the vintage), and what is near enough in time comes of a sweep over the days of each bucket (_swept): work follows the
    rows of both sides, however many rates a code has. A bucket (system, code, carrier, setting, class) is one task's, which holds the
    payer rates of one question. A row with rates near enough is compared; any other has what its spelling has.
    """
    billing = F.when((X.folded(F.col("billing_class")) == "") & assumed, F.lit("facility")).otherwise(F.col("billing_class")) if assumed is not None else F.col("billing_class")
    left = left.withColumn("stated_class", F.col("billing_class")).withColumn("billing_class", billing)
    columns = left.columns
    left, right, kinds, payer = _written(left, right)
    out = left.join(_swept(left, right, kinds, payer, days), _SWEPT, "left").join(_refused(kinds, payer), _SPELLING, "left")
    done = F.col("n").isNotNull()
    kinds = {f.name: f.dataType for f in right.schema}
    return out.select(
        *(F.col(c) for c in columns if c not in ("billing_class", "stated_class")), F.col("stated_class").alias("billing_class"), F.when(done, "compared").otherwise(F.col("refused")).alias("outcome"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n"), F.col("payer_min").cast(kinds["rate"]).alias("payer_min"), "payer_median", F.col("payer_max").cast(kinds["rate"]).alias("payer_max"), "networks",
        F.col("near_plan").alias("payer_plan"), F.date_add(F.lit("1970-01-01").cast("date"), F.col("near_day").cast("int")).cast(kinds["vintage"]).alias("payer_vintage"), F.col("near_product").alias("payer_product_class"),
    )


def explain(compared: DataFrame) -> DataFrame:
    """Columns ratio, relative_difference, is_material, inside, payer_label and explanation for compared rows of distribution_join.

    The first account that holds: too far apart to be one service, an aggregate plan, inside the payer's range, drift over the
    days between the vintages, plans that don't match; else unexplained. What plans and networks have to do with each other is found
    once for all rows that have the same ones, so the comparison goes to a working table."""
    marks = _fingerprint([F.col("plan"), F.size("networks"), F.col("networks"), F.col("payer_plan")], ["_v1", "_v2"])
    columns = compared.columns
    compared = _table(compared.withColumns(marks), "compared")
    a, b = F.col("rate"), F.col("payer_median")
    aggregate = lambda c: F.coalesce(F.col(c).isin(T.AGGREGATE_PRODUCTS), F.lit(False))
    inside = F.coalesce(a.between(F.col("payer_min"), F.col("payer_max")), F.lit(False))
    mine = X.network_tokens(F.col("plan"))
    verdicts = F.transform("networks", lambda x: X.tokens_verdict(F.col("_mine"), X.network_tokens(x)))
    many, stated = F.size("networks") > 1, X.folded(F.col("plan")) != ""
    verdict = F.when(many, F.when(F.array_contains(verdicts, "match"), "match").when(F.array_contains(verdicts, "aggregate"), "aggregate").otherwise("no_match"))
    verdict = F.when(many & stated, verdict).when(~many & X.differs(F.col("plan"), F.col("payer_plan")), X.plan_verdict(F.col("plan"), F.col("payer_plan"))).otherwise("match")
    label = F.when(many, F.array_join("networks", " + ")).otherwise(F.coalesce("payer_plan", F.lit("")))
    named = compared.select("_v1", "_v2", "plan", "networks", "payer_plan").distinct().withColumn("_mine", mine)
    named = _table(named.select("_v1", "_v2", verdict.alias("_verdict"), label.alias("payer_label")), "verdicts")
    verdict = F.col("_verdict")
    explanation = (
        F.when(N.implausible(a, b), "entity_resolution_suspect")
        .when((aggregate("product_class") | aggregate("payer_product_class")) & ~F.col("product_class").eqNullSafe(F.col("payer_product_class")), "granularity_mismatch")
        .when((F.col("n") >= 2) & (F.col("payer_max") > F.col("payer_min")) & inside, "within_payer_range")
        .when(N.drift_explains(a, b, N.days_apart(F.col("vintage"), F.col("payer_vintage"))), "vintage_artifact")
        .when(verdict == "aggregate", "granularity_mismatch")
        .when(verdict != "match", "plan_unresolved")
        .otherwise("unexplained")
    )
    return compared.join(named, ["_v1", "_v2"], "left").withColumns({
        "ratio": N.ratio(b, a), "relative_difference": N.relative_difference(a, b), "is_material": N.material(a, b), "is_implausible": N.implausible(a, b), "inside": inside,
        "explanation": explanation,
    }).select(*columns, "ratio", "relative_difference", "is_material", "is_implausible", "inside", "payer_label", "explanation")


CONTRACT = ["facility", "carrier", "plan", "payer_label"]


def systematic_offsets(rows: DataFrame, contract: list[str] = CONTRACT, tolerance: float = T.OFFSET_TOLERANCE, share: float = T.OFFSET_SHARE, codes: int = T.OFFSET_CODES) -> DataFrame:
    """Contracts in which nearly all codes have one ratio: the contract, offset (the median ratio of those), codes and rows.

    A null in the contract is a value like others. Both medians are windows over the contract, which is shuffled once."""
    w = Window.partitionBy(*contract)
    r = rows.where("ratio > 0").select(*contract, "code", "ratio")
    r = r.withColumns({"_n": F.count("*").over(w), "_centre": F.median("ratio").over(w)})
    r = r.withColumn("_inside", F.abs(F.col("ratio") - F.col("_centre")) / F.col("_centre") <= tolerance)
    found = r.groupBy(*contract).agg(F.first("_n").alias("_n"), F.count_if("_inside").alias("rows"), F.countDistinct(F.when(F.col("_inside"), F.col("code"))).alias("codes"), F.median(F.when(F.col("_inside"), F.col("ratio"))).alias("offset"))
    return found.where((F.col("_n") >= codes) & (F.col("codes") >= codes) & (F.col("rows") / F.col("_n") >= share)).drop("_n")


def reclassify(rows: DataFrame, offsets: DataFrame, contract: list[str] = CONTRACT, tolerance: float = T.OFFSET_TOLERANCE, keep: str | None = None) -> DataFrame:
    """Unexplained rows whose ratio is their contract's offset become systematic_offset. keep: a column for the offset."""
    o = offsets.select(*(F.col(c).alias(f"_o_{c}") for c in contract), F.col("offset").alias("_offset"))
    on = reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in contract))
    out = rows.join(o, on, "left")
    near = F.coalesce(F.abs(F.col("ratio") - F.col("_offset")) / F.col("_offset") <= tolerance, F.lit(False))
    return out.withColumn("explanation", F.when((F.col("explanation") == "unexplained") & near, "systematic_offset").otherwise(F.col("explanation"))).select(*rows.columns, *([F.col("_offset").alias(keep)] if keep else []))


def with_offsets(explained: DataFrame, written: bool = False) -> DataFrame:
    """Outcomes with offsets applied: offsets come of all compared rows, whatever accounts for them, and account for those that nothing
    else does, material or not. explanation_before is the account without them; contract_offset is the contract's. The rows are read
    twice, so unless they come of tables already (written, as those of explain do) they go to a working table first: else the whole comparison would run twice. Offsets are a table too, so what is returned reads
    two tables, however often it is read."""
    explained = explained if written else _table(explained, "explained")
    offsets = _table(systematic_offsets(explained.where("outcome = 'compared'")), "offsets")
    out = reclassify(explained.withColumn("explanation_before", F.col("explanation")), offsets, keep="contract_offset")
    return out.withColumn("contract_offset", F.when(F.col("outcome") == "compared", F.col("contract_offset")))


def across_facilities(rates: DataFrame, keys: list[str], facility: str = "facility", rate: str = "rate") -> DataFrame:
    """Cheapest and dearest facility per key, by each facility's upper-median rate; of ties the first by name."""
    from .aggregate import median_row

    each = median_row(rates.where(f"{rate} > 0"), [*keys, facility], [F.col(rate)], upper=True).select(*keys, facility, rate)
    out = each.groupBy(*keys).agg(
        F.count("*").alias("facilities"), F.min(rate).alias("low"), F.min_by(facility, F.struct(rate, facility)).alias("low_facility"),
        F.max(rate).alias("high"), F.min_by(facility, F.struct(-F.col(rate), F.col(facility))).alias("high_facility"),
    )
    return out.where("facilities >= 2").withColumns({"ratio": N.ratio(F.col("high"), F.col("low")), "relative_difference": N.relative_difference(F.col("low"), F.col("high"))})


def system_range(left: DataFrame, right: DataFrame, keys: list[str], min_facilities: int = 2) -> DataFrame:
    """The payer's median against the range of the facilities' medians, per key."""
    each = left.groupBy(*keys, "facility").agg(F.median("rate").alias("rate"))
    hospital = each.groupBy(*keys).agg(F.count("*").alias("facilities"), F.min("rate").alias("low"), F.median("rate").alias("hospital_median"), F.max("rate").alias("high")).where(F.col("facilities") >= min_facilities)
    payer = right.groupBy(*keys).agg(F.median("rate").alias("payer_rate"), F.count("*").alias("payer_rows"))
    low, high, paid = F.col("low"), F.col("high"), F.col("payer_rate")
    gap = F.when((paid < low) & (paid != 0), low / paid).when((paid > high) & (high != 0), paid / high).otherwise(1.0)
    out = hospital.join(payer, keys).withColumns({"width": N.ratio(high, low), "gap": gap, "vs_median": N.ratio(paid, F.col("hospital_median"))})
    return out.withColumn("verdict", F.when(F.col("gap") >= T.IMPLAUSIBLE, "implausible").when(paid < low, "below").when(paid > high, "above").otherwise("inside"))
