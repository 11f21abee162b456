"""Targeting classes, redshift ranks and the repair of doubtful redshifts.

Inputs are the redshift table ``(target_id, znum, z, zerr, zwarn, class, chi2)``, the scan
``(target_id, template, i, z, chi2)`` and targeting hints ``(target_id, targclass, targprog,
targsrvy)``. All keys are targets; every choice of a best row is a combinable ``min`` over a
struct, so a target with very many rows is no hot group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.functions.exprs import C_KMS, ratio
from lumenframe.operators.select import prior_table

# Keywords of targeting texts, tested in this order.
CLASS_KEYWORDS = (
    ("STAR", ("STAR", "WD", "CV", "MS", "STELLAR", "OB", "GIANTS", "DWARFS")),
    ("QSO", ("QSO", "QUASAR", "AGN", "BLAZAR", "SEYFERT")),
    ("GALAXY", ("GALAXY", "GALAXIES", "ELG", "LRG", "BCG", "NEBULA", "NEBULAE", "HII", "EMISSION", "EXTRAGAL")),
)

# Bits of the redshift warning set by the repair.
ZW_CLASS_MISMATCH = 1 << 16
ZW_RATIO = 1 << 17
ZW_Z_SHIFT = 1 << 18
ZW_SWAP_APPLIED = 1 << 19
ZW_NO_VALID_RANK = 1 << 20
ZW_SCAN_UNRELIABLE = 1 << 21
ZW_SCAN_CONFIRMS = 1 << 22
ZW_REFERENCE_IS_FIT = 1 << 23
ZW_TARGETING_OVERRIDE = 1 << 24
ZW_Z_IMPROVED = 1 << 25
ZW_MINFIT_RELAXED = 1 << 26
BAD_MINFIT = 1 << 10
NATIVE_BITS = 0xFFFF


def keyword_class(text: Column, *, nan_is_empty: bool = False) -> Column:
    """Class whose keyword occurs in the text, NULL if none does."""
    t = F.upper(F.trim(text))
    empty = ["", "NONE", "NULL"] + (["NAN"] if nan_is_empty else [])
    out = F.lit(None).cast("string")
    for name, words in reversed(CLASS_KEYWORDS):
        out = F.when(t.rlike("|".join(words)), name).otherwise(out)
    return F.when(t.isNotNull() & ~t.isin(empty), out)


def targeting_hint(cls: str = "targclass", prog: str = "targprog", srvy: str = "targsrvy") -> Column:
    return F.coalesce(keyword_class(F.col(cls)), keyword_class(F.col(prog)), keyword_class(F.col(srvy)))


def survey_class(
    target: DataFrame, *, codes: Sequence[tuple[str, str]] = (), default: str | None = None, cls: str = "targclass", prog: str = "targprog", srvy: str = "targsrvy"
) -> DataFrame:
    """Class from targeting: keywords in the class, then in the programme, then the survey code
    table ``(class, code)`` (exact before substring, in table order), else the fitted class.

    The code table is a short configured list and becomes one expression; nothing is joined.
    """
    s = F.upper(F.trim(F.col(srvy)))
    exact = part = F.lit(None).cast("string")
    for name, code in reversed(list(codes)):
        exact = F.when(s == code.upper(), name).otherwise(exact)
        part = F.when(F.contains(s, F.lit(code.upper())), name).otherwise(part)
    by_survey = F.when(s.isNotNull() & ~s.isin(["", "NONE", "NULL", "NAN"]), F.coalesce(exact, part))
    found = [keyword_class(F.col(cls), nan_is_empty=True), keyword_class(F.col(prog), nan_is_empty=True), by_survey]
    if default is not None:
        found.append(F.col(default))
    return target.withColumn("srvy_class", F.coalesce(*found))


def star_prior_table(hints: DataFrame, *, sigma: float) -> DataFrame:
    """Prior at redshift 0 for targets whose targeting says star."""
    stars = hints.where(targeting_hint() == "STAR").select("target_id", F.lit(0.0).alias("z"))
    return prior_table(stars, sigma=sigma)


def rank_best(zfit: DataFrame, *, ntop: int = 3, values: Sequence[str] = ("z", "zerr", "zwarn", "class", "chi2")) -> DataFrame:
    """The first ``ntop`` ranks of each target as arrays; targets need more than ``ntop`` rows.

    The row_number filter is a limit per group, applied before and after the shuffle, so at
    most ``ntop + 1`` rows per target and task are moved.
    """
    rank = F.row_number().over(Window.partitionBy("target_id").orderBy("znum"))
    top = zfit.withColumn("_r", rank).where(F.col("_r") <= ntop + 1)
    packed = top.groupBy("target_id").agg(F.array_sort(F.collect_list(F.struct("_r", *values))).alias("s"))
    kept = packed.where(F.size("s") > ntop).withColumn("s", F.slice("s", 1, ntop))
    return kept.select("target_id", *[F.col("s")[v].alias(v) for v in values])


def rank_rows(best: DataFrame, *, ranked: Sequence[str], single: Sequence[str] = ()) -> DataFrame:
    """One row per rank; columns without ranks appear on rank 0 only."""
    out = best.select("target_id", *single, F.posexplode(F.arrays_zip(*ranked)).alias("rank", "_e"))
    return out.select(
        "target_id", "rank", *[F.col("_e")[c].alias(c) for c in ranked], *[F.when(F.col("rank") == 0, F.col(c)).alias(c) for c in single]
    )


def inject_class(zfit: DataFrame, hints: DataFrame, *, ntop: int = 3) -> DataFrame:
    """Top ranks, long form, in which the targeting class occurs wherever a fit of it exists.

    If none of the top ranks has the class, the last of them is replaced by the matching fit
    of lowest chi2 (counted 1.5 times with a warning), ranks beyond the top first. All columns
    of the fit move, whatever they are; only ``target_id`` and ``znum`` stay.
    """
    srvy = hints.select("target_id", targeting_hint().alias("_hint")).where("_hint IS NOT NULL")
    match = F.upper(F.trim("class")) == F.col("_hint")
    cost = F.col("chi2") * F.when(F.col("zwarn") == 0, 1.0).otherwise(1.5)
    inside = F.when(F.col("znum") >= ntop, 0).otherwise(1)
    moved = [c for c in zfit.columns if c not in ("target_id", "znum")]
    pick = F.min_by(F.struct(*moved), F.when(match, F.struct(inside.alias("tier"), cost.alias("cost"), "znum")))
    picked = zfit.join(srvy, "target_id").groupBy("target_id").agg(F.bool_or(match & (F.col("znum") < ntop)).alias("_present"), pick.alias("_p"))
    picked = picked.where("NOT _present AND _p IS NOT NULL").select("target_id", "_p")
    top = zfit.where(F.col("znum") < ntop).join(picked, "target_id", "left")
    use = F.col("_p").isNotNull() & (F.col("znum") == ntop - 1)
    cols = {c: F.when(use, F.col("_p")[c]).otherwise(F.col(c)) for c in moved}
    return top.withColumns(cols).withColumn("injected", use).drop("_p")


def refine_minimum(scan: DataFrame, *, window: float = 0.05, min_points: int = 5) -> DataFrame:
    """Parabola through the scan around the lowest chi2 of each (target, class).

    The template with the lowest minimum stands for its class. The least-squares parabola
    comes from power sums of the centred redshift, so the points are never gathered.
    """
    rows = scan.withColumn("class", F.substring_index("template", ":::", 1))
    best = rows.groupBy("target_id", "class").agg(F.min(F.struct("chi2", "template", "i", "z")).alias("m"))
    best = best.select("target_id", "class", F.col("m.chi2").alias("best_chi2"), F.col("m.template").alias("template"), F.col("m.z").alias("z0"))
    near = rows.drop("class").join(best, ["target_id", "template"]).where((F.col("z") >= F.col("z0") - window) & (F.col("z") <= F.col("z0") + window))
    u, y = (F.col("z") - F.col("z0")) / window, F.col("chi2")
    powers = {f"s{k}": F.sum(F.pow(u, F.lit(float(k)))) for k in (1, 2, 3, 4)}
    moments = {f"t{k}": F.sum(F.pow(u, F.lit(float(k))) * y) for k in (0, 1, 2)}
    s = near.groupBy("target_id", "class", "z0", "best_chi2").agg(
        F.count("*").alias("n"), F.min("z").alias("zlo"), F.max("z").alias("zhi"), *[e.alias(n) for n, e in {**powers, **moments}.items()]
    )
    n, s1, s2, s3, s4 = (F.col(c) for c in ("n", "s1", "s2", "s3", "s4"))
    t0, t1, t2 = (F.col(c) for c in ("t0", "t1", "t2"))
    det = n * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s2 * s3) + s2 * (s1 * s3 - s2 * s2)
    det = F.when((F.col("n") >= min_points) & (F.abs(det) > 1e-12), det)
    c2 = (n * (s2 * t2 - s3 * t1) - s1 * (s1 * t2 - s2 * t1) + t0 * (s1 * s3 - s2 * s2)) / det
    c1 = (n * (t1 * s4 - t2 * s3) - t0 * (s1 * s4 - s2 * s3) + s2 * (s1 * t2 - s2 * t1)) / det
    c0 = (t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - t2 * s3) + s2 * (t1 * s3 - t2 * s2)) / det
    out = s.withColumns({"_c2": c2, "_c1": c1, "_c0": c0})
    vertex = ratio(-F.col("_c1"), F.col("_c2") * 2.0)
    curvature = F.col("_c2") / (window * window)
    out = out.withColumns(
        {"z_fit": F.col("z0") + vertex * window, "chi2_fit": F.col("_c0") + F.col("_c1") * vertex + F.col("_c2") * vertex * vertex, "curvature": curvature}
    )
    floor = F.greatest(F.col("best_chi2"), F.lit(1.0))
    reliable = (
        (F.col("curvature") > 0)
        & F.col("z_fit").between(F.col("zlo"), F.col("zhi"))
        & (F.abs(F.col("chi2_fit") - F.col("best_chi2")) / floor <= 0.05)
        & (F.col("curvature") / floor >= 1e-5)
    )
    return out.select(
        "target_id", "class", F.col("z0").alias("z_scan"), "best_chi2", "n",
        F.coalesce("z_fit", "z0").alias("z_fit"), F.coalesce("chi2_fit", "best_chi2").alias("chi2_fit"),
        F.when(F.col("curvature") > 0, 1.0 / F.sqrt("curvature")).alias("z_sigma"), F.coalesce("curvature", F.lit(0.0)).alias("curvature"),
        (F.abs(F.coalesce("z_fit", "z0") - F.col("z0")) / (F.col("z0") + 1.0) * C_KMS).alias("dv"),
        F.coalesce(reliable, F.lit(False)).alias("reliable"),
    )


def fallback_redshift(zfit: DataFrame, scan: DataFrame, hints: DataFrame, *, worse: float = 1.5, relax: float = 3.0, max_shift: float = 3000.0, max_confirm: float = 1000.0) -> DataFrame:
    """Compare rank 0 with the coarse scan and swap in a better rank where they disagree.

    Triggers: another class (not for galaxy/QSO at one redshift), a much higher chi2, or a
    large shift within the class. Targeting that backs the fitted class against the scan
    cancels the first and relaxes the second; a fit at least as good as the scan in its own
    class cancels the third. The replacement is the row of the scan's class nearest to the
    reference redshift, without serious warnings (or, for a bare class mismatch, with only a
    doubtful minimum). All columns of the two ranks change places, not only the redshift's own.
    Warning bits record every decision.
    """
    fit = refine_minimum(scan)
    coarse = fit.groupBy("target_id").agg(F.min(F.struct("best_chi2", "class", "z_scan", "z_fit", "dv", "reliable")).alias("s")).select("target_id", "s.*")
    coarse = coarse.where(F.col("best_chi2") > 0).withColumnRenamed("class", "scan_class")
    moved = [c for c in zfit.columns if c not in ("target_id", "znum")]
    first = zfit.where("znum = 0").select(
        "target_id", F.col("z").alias("_z"), F.col("zwarn").alias("_zwarn"), F.col("class").alias("_class"), F.col("chi2").alias("_chi2"), F.struct(*moved).alias("_first")
    )
    d = first.join(coarse, "target_id").join(hints.select("target_id", targeting_hint().alias("_hint")), "target_id", "left")
    same = F.col("_class") == F.col("scan_class")
    pair = ((F.col("_class") == "GALAXY") & (F.col("scan_class") == "QSO")) | ((F.col("_class") == "QSO") & (F.col("scan_class") == "GALAXY"))
    d = d.withColumns(
        {
            "confirms": F.col("reliable") & (F.col("dv") < max_confirm),
            "improved": same & (F.col("_chi2") <= F.col("best_chi2")),
            "override": F.coalesce((F.col("_class") == F.col("_hint")) & (F.col("scan_class") != F.col("_hint")), F.lit(False)),
        }
    )
    z_ref = F.when(F.col("improved"), F.col("_z")).when(F.col("confirms"), F.col("z_fit")).otherwise(F.col("z_scan"))
    mismatch = (
        F.when(same, False).when(pair, F.abs(F.col("_z") - F.col("z_scan")) >= 0.01).when(F.col("override"), False).otherwise(True)
    )
    limit = F.when(F.col("override"), worse * relax).otherwise(worse)
    shift = F.abs(F.col("_z") - F.col("z_scan")) / (F.col("z_scan") + 1.0) * C_KMS
    d = d.withColumns(
        {
            "z_ref": z_ref,
            "mismatch": mismatch,
            "too_bad": F.col("_chi2") / F.col("best_chi2") > limit,
            "shifted": same & (shift > max_shift) & ~F.col("improved"),
        }
    )
    d = d.withColumn("trigger", F.col("mismatch") | F.col("too_bad") | F.col("shifted"))

    def bits(**flags: int) -> Column:
        return sum((F.when(F.col(k), v).otherwise(0) for k, v in flags.items()), F.lit(0))

    base = bits(confirms=ZW_SCAN_CONFIRMS | ZW_REFERENCE_IS_FIT) + F.when(~F.col("reliable"), ZW_SCAN_UNRELIABLE).otherwise(0)
    triggers = bits(mismatch=ZW_CLASS_MISMATCH, too_bad=ZW_RATIO, shifted=ZW_Z_SHIFT)
    d = d.withColumns({"_base": base, "_trig": triggers, "_extra": bits(override=ZW_TARGETING_OVERRIDE, improved=ZW_Z_IMPROVED)})
    # The replacement, one combinable minimum per target.
    rows = zfit.select("target_id", "znum", "z", "zwarn", "class", F.struct(*moved).alias("row"))
    cand = rows.join(d.where("trigger").select("target_id", "scan_class", "z_ref", "mismatch", "override"), "target_id")
    native = F.col("zwarn").bitwiseAND(NATIVE_BITS)
    tier = F.when(native <= 2, 0).when(F.col("mismatch") & ~F.col("override") & (native.bitwiseAND(F.bitwise_not(F.lit(BAD_MINFIT))) <= 2), 1)
    dist = F.abs(F.col("z") - F.col("z_ref")) + F.when(native == 0, 0.0).otherwise(0.5)
    ok = (F.col("class") == F.col("scan_class")) & tier.isNotNull()
    entry = F.struct(tier.alias("tier"), "znum", "row")
    found = cand.groupBy("target_id").agg(F.min_by(entry, F.when(ok, F.struct(tier.alias("tier"), dist.alias("dist"), "znum"))).alias("r"))
    d = d.join(found, "target_id", "left").withColumn("swap", F.coalesce(F.col("r.znum") > 0, F.lit(False)))
    decided = d.select(
        F.col("target_id").alias("_tid"), *[F.col(c).alias("_d_" + c) for c in ("trigger", "swap")], "_base", "_trig", "_extra", F.col("r").alias("_r"), "_zwarn", "_first"
    )
    out = zfit.join(decided, F.col("target_id") == F.col("_tid"), "left")
    is0, is_r = F.col("znum") == 0, F.coalesce(F.col("znum") == F.col("_r.znum"), F.lit(False))
    swap = F.coalesce(F.col("_d_swap"), F.lit(False))
    old = F.col("_zwarn").bitwiseOR((F.col("_base") + F.col("_trig") + F.col("_extra")).cast("int"))
    kept = old.bitwiseOR(F.when(F.col("_d_trigger") & ~swap, ZW_NO_VALID_RANK).otherwise(0))
    new = F.col("_r.row.zwarn").bitwiseAND(NATIVE_BITS).bitwiseOR(
        (F.col("_base") + F.col("_trig") + ZW_SWAP_APPLIED + F.when(F.col("_r.tier") == 1, ZW_MINFIT_RELAXED).otherwise(0)).cast("int")
    )
    to0, to_r = is0 & swap, is_r & swap
    cols = {c: F.when(to0, F.col("_r.row")[c]).when(to_r, F.col("_first")[c]).otherwise(F.col(c)) for c in moved}
    cols["zwarn"] = F.when(to0, new).when(to_r, old).when(is0 & F.col("_tid").isNotNull(), kept).otherwise(F.col("zwarn"))
    return out.withColumns(cols).select(*zfit.columns)


def target_availability(target: DataFrame, star: DataFrame, galaxy: DataFrame) -> DataFrame:
    """Which results a target has. ``star`` is (target_id, vrad, teff), ``galaxy`` is
    (target_id, v, emission_peak) with the largest absolute emission of its spectrum."""
    out = target.select("target_id").join(star, "target_id", "left").join(galaxy, "target_id", "left")
    has = {"rvs": F.col("vrad").isNotNull(), "grid": F.col("teff").isNotNull(), "kin": F.col("v").isNotNull(), "emi": F.coalesce(F.col("emission_peak") > 0, F.lit(False))}
    out = out.select("target_id", *[F.coalesce(c, F.lit(False)).alias(k) for k, c in has.items()])
    gal, ex = F.col("rvs") | F.col("grid"), F.col("kin") | F.col("emi")
    return out.withColumn("results", F.when(gal & ex, "both").when(gal, "gal").when(ex, "exgal").otherwise("none"))


def best_grid(fits: DataFrame, *, first_grid: int = 1, min_grids: int = 5) -> DataFrame:
    """Per object the accepted fit of lowest chi2 over model grids (ties: lowest grid).

    A fit is rejected at chi2 = -1000, or with a temperature within 1 % of the grid's lower
    limit (not for the first grid). Fewer grids than ``min_grids`` is an error.
    """
    grids = fits.select("grid").distinct().limit(min_grids).count()
    if grids < min_grids:
        raise ValueError(f"{grids} grids available, {min_grids} required")
    ok = (F.col("chi2") != -1000) & ((F.col("grid") == first_grid) | (F.col("teff") > F.col("teff_limit") * 1.01))
    cols = [c for c in fits.columns if c != "obj_id"]
    best = fits.where(ok).groupBy("obj_id").agg(F.min(F.struct("chi2", "grid", *[c for c in cols if c not in ("chi2", "grid")])).alias("b"))
    return best.select("obj_id", "b.*")


def stellar_flags(stars: DataFrame, *, min_vel: float = -1500.0, max_vel: float = 1500.0) -> DataFrame:
    """Quality flag (chi2 < 1 and SNR > 5) and the warning bits of a radial-velocity fit."""
    edge = lambda c, lo, hi, t: (F.col(c) < lo + t) | (F.col(c) > hi - t)
    tests = (
        # Bit and test.
        (1, F.col("dchi2") < 50),
        (2, edge("vrad", min_vel, max_vel, 5.0)),
        (4, F.col("vrad_err") > 100),
        (8, edge("teff", 2300.0, 15000.0, 10.0) | edge("feh", -4.0, 1.0, 0.01) | edge("logg", -0.5, 6.5, 0.01)),
        (16, F.col("vsini") > 20),
        (64, F.col("bad_hessian") == 1),
    )
    warn = sum((F.when(t, bit).otherwise(0) for bit, t in tests), F.lit(0))
    good = F.when((F.col("chi2") < 1.0) & (F.col("snr") > 5.0), 1).otherwise(0)
    return stars.withColumns({"flag": good, "warn": warn})
