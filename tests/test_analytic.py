"""Small tables with known answers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.functions.exprs import lens_area
from lumenframe.operators import bins, classify, curves, detect, lines, merge, patches, quality, ranges, select, spatial, spectra
from lumenframe.sources import tables

PIX = "spec_id int, arm string, pix int, wave double, flux double, ivar double"


def spectrum(flux, ivar=None, arm="B", spec=1, start=4000.0, step=1.0):
    ivar = [1.0] * len(flux) if ivar is None else ivar
    return [(spec, arm, i, start + step * i, None if f is None else float(f), float(v)) for i, (f, v) in enumerate(zip(flux, ivar))]


def column(df, name, order="pix"):
    return [r[name] for r in sorted(df.collect(), key=lambda r: r[order])]


@pytest.mark.parametrize("d,r1,r2,area", [(0, 1, 1, math.pi), (2, 1, 1, 0), (3, 1, 1, 0), (0.5, 1, 0.5, math.pi / 4)])
def test_lens_area(frame, d, r1, r2, area):
    got = frame([(float(d),)], "d double").select(lens_area(F.col("d"), float(r1), float(r2)).alias("a")).first()["a"]
    assert got == pytest.approx(area, abs=1e-9)


def test_weights_fall_with_distance_and_sum_to_one(frame):
    r = 1.3 / 3600
    spaxel = frame([(1, 10.0, 20.0)], "spaxel_id int, ra double, dec double")
    fibre = frame([(1, 1, 10.0, 20.0), (2, 2, 10.0, 20.0 + r), (3, 3, 10.0, 20.01)], "fibre_id int, nspec int, ra double, dec double")
    for mode in ("overlap", "distance"):
        got = {x["fibre_id"]: x["weight"] for x in spatial.overlap_weights(spaxel, fibre, fibre_radius=r, spaxel_radius=0.25 / 3600, weighting=mode).collect()}
        assert got[1] > got[2] > 0 and 3 not in got
        assert sum(got.values()) == pytest.approx(1.0)


def test_aperture_axes_are_full_lengths(frame):
    def inside(a, b, angle, d, pa):
        ra = 150.0 + d / 3600 * math.sin(math.radians(pa)) / math.cos(math.radians(2.0))
        t = frame([(1, ra, 2.0 + d / 3600 * math.cos(math.radians(pa)))], "target_id int, ra double, dec double")
        r = frame([(1, 150.0, 2.0, a, b, angle)], "region_id int, ra0 double, dec0 double, a double, b double, angle double")
        return select.in_ellipse(t, r).count() == 1

    assert inside(10.0, 10.0, 0.0, 4.8, 0.0) and not inside(10.0, 10.0, 0.0, 5.2, 90.0)
    assert inside(10.0, 6.0, 0.0, 4.9, 90.0) and not inside(10.0, 6.0, 0.0, 3.2, 0.0)
    assert inside(10.0, 6.0, 90.0, 4.9, 0.0) and not inside(10.0, 6.0, 90.0, 3.2, 90.0)


def test_best_repeat_needs_a_list(frame):
    t = frame([("X", 1, "T"), ("X", 2, "T"), ("X", 3, "S")], "cname string, spec_id int, targuse string")
    s = frame([(1, "B", 5.0), (2, "B", 7.0), (2, "R", 9.0), (3, "B", 99.0)], "spec_id int, arm string, snr double")
    assert select.best_repeat(t, s).count() == 0
    got = select.best_repeat(t, s, cnames=frame([("X",)], "cname string")).collect()
    assert [r["spec_id"] for r in got] == [2]


def test_bins_of_one_and_two_spaxels(frame):
    px = frame([(s, p, float(10 * s + p), 1.0) for s in range(4) for p in range(6)], "spec_id int, pix int, flux double, var double")
    m = frame([(0, 0), (1, 1), (2, 1), (3, 2)], "spec_id int, bin_id int")
    got = {(r["bin_id"], r["pix"]): (r["flux"], r["var"]) for r in bins.bin_spectra_sum(px, m).collect()}
    assert got[(1, 3)] == (13.0 + 23.0, 2.0) and got[(0, 5)] == (5.0, 1.0)
    assert bins.bin_spectra_sum(px).select("bin_id").distinct().count() == 4


def test_every_spaxel_has_one_provenance_code(frame):
    rows = [(i, 0, float(i % 7), float(i // 7), 1.0 + i, 1.0, 1.0 + i) for i in range(49)]
    s = frame(rows, "target_id int, field int, x double, y double, signal double, noise double, snr double")
    flux = s.where("signal >= 10")
    got = bins.bin_provenance(s, flux, bins.grid_assign(flux, size=2.0, min_snr=20.0)).collect()
    assert len(got) == 49
    codes = {r["target_id"]: r["bin_id"] for r in got}
    assert codes[0] == -1 and codes[12] == -999 and codes[40] >= 0


def test_line_index(frame):
    band = frame([("a", 4010.0, 4020.0, 4030.0, 4040.0, 4050.0, 4060.0, 1), ("far", 3000.0, 3010.0, 3020.0, 3030.0, 3040.0, 3050.0, 1)],
                 "name string, b1 double, b2 double, b3 double, b4 double, b5 double, b6 double, kind int")
    flat = frame(spectrum([1.0] * 80), PIX)
    got = {r["name"]: r["index"] for r in lines.line_indices(flat, band).collect()}
    assert got["a"] == pytest.approx(0.0, abs=1e-12) and got["far"] is None
    dip = frame(spectrum([0.5 if 33 <= i <= 37 else 1.0 for i in range(80)]), PIX)
    assert {r["name"]: r["index"] for r in lines.line_indices(dip, band).collect()}["a"] > 0.5
    half = band.select("name", *[(F.col(f"b{i}") + 0.3).alias(f"b{i}") for i in range(1, 7)], "kind")
    assert {r["name"]: r["index"] for r in lines.line_indices(flat, half).collect()}["a"] == pytest.approx(0.0, abs=1e-12)
    mostly_bad = frame(spectrum([1.0 if i < 5 else None for i in range(80)]), PIX)
    assert all(r["index"] is None for r in lines.line_indices(mostly_bad, band).collect())


def test_index_errors_grow_with_noise(frame):
    band = frame([("a", 4010.0, 4020.0, 4030.0, 4040.0, 4050.0, 4060.0, 1)], "name string, b1 double, b2 double, b3 double, b4 double, b5 double, b6 double, kind int")
    px = frame(spectrum([1.0] * 80) + spectrum([1.0] * 80, spec=2), PIX).withColumn("noise", F.when(F.col("spec_id") == 1, 0.01).otherwise(0.1))
    got = {r["spec_id"]: r["index_error"] for r in lines.line_index_errors(px, band, replicas=60, seed=1).collect()}
    assert 5 < got[2] / got[1] < 20
    again = {r["spec_id"]: r["index_error"] for r in lines.line_index_errors(px.repartition(7), band, replicas=60, seed=1).collect()}
    assert again == pytest.approx(got)
    assert lines.line_index_errors(px, band, replicas=5).where("index_error IS NOT NULL").count() == 0


def gaussian(spec, s):
    out = []
    for i in range(len(spec)):
        r = int(4 * s)
        w = [math.exp(-0.5 * (o / s) ** 2) for o in range(-r, r + 1)]
        v = [spec[min(max(i + o, 0), len(spec) - 1)] for o in range(-r, r + 1)]
        out.append(sum(a * b for a, b in zip(w, v)) / sum(w))
    return out


def test_broadening(frame):
    spec = [0.0] * 40
    spec[20] = 1.0
    def run(flux, sigma):
        df = frame([(1, [None if f is None else float(f) for f in flux], [float(s) for s in sigma])], "spec_id int, flux array<double>, sigma array<double>")
        return spectra.broaden_variable(df).first()["flux"]

    got = run(spec, [2.0] * 40)
    assert got == pytest.approx(gaussian(spec, 2.0)) and sum(got) == pytest.approx(1.0)
    assert run(spec, [0.0] * 40) == spec
    hole = list(spec)
    hole[5] = None
    out = run(hole, [1.0] * 40)
    assert [i for i, v in enumerate(out) if v is None] == list(range(1, 10))


def test_running_mean_repeats_the_ends(frame):
    df = frame(spectrum([1.0, 2.0, 4.0, 8.0]), PIX)
    got = column(spectra.continuum_subtract(df, window=3), "continuum")
    assert got == pytest.approx([(1 + 1 + 2) / 3, 7 / 3, 14 / 3, 20 / 3])


def test_cosmic_ray_and_edges(frame):
    flux = [100.0, 1, 1, 1, 90, 1, 1, 1]
    got = column(spectra.cosmic_ray_mask(frame(spectrum(flux), PIX)), "ivar")
    assert got == [1, 1, 1, 0, 0, 0, 1, 1]


def test_gap_filling_and_islands(frame):
    flux, ivar = [9.0, 1, 9, 9, 4, 9], [0, 1, 0, 0, 1, 0]
    df = frame(spectrum(flux, ivar), PIX)
    assert column(spectra.fill_gaps(df), "flux") == pytest.approx([1, 1, 2, 3, 4, 4])
    runs = sorted((r["first_pix"], r["last_pix"], r["length"], r["interior"], r["detector_gap"]) for r in spectra.gap_islands(df).collect())
    assert runs == [(0, 0, 1, False, False), (2, 3, 2, True, True), (5, 5, 1, False, False)]
    all_bad = frame(spectrum([1.0, None], [0, 0]), PIX)
    assert column(spectra.fill_gaps(all_bad), "flux") == [1.0, None]


def test_missing_values_mask(frame):
    df = frame([(1, "B", 0, 1.0, None, 5.0), (1, "B", 1, 2.0, float("nan"), 5.0), (1, "B", 2, 3.0, 1.0, -1.0), (1, "B", 3, 4.0, 1.0, float("nan")), (1, "B", 4, 5.0, 1.0, 2.0)], PIX)
    assert column(spectra.mask_invalid(df), "ivar") == [0, 0, 0, 0, 2]


def test_half_of_the_pixels_must_be_good(frame):
    df = frame(spectrum([2.0] * 4, [4, 4, 0, 0]) + spectrum([2.0] * 4, [4, 0, 0, 0], spec=2), PIX)
    got = {r["spec_id"]: r["snr"] for r in spectra.spectrum_snr(df).collect()}
    assert got == {1: 4.0, 2: None}


def test_join_arms_gap_overlap_and_jump(frame):
    blue = spectrum([1.0] * 10, arm="B")
    gap = spectrum([1.0] * 10, arm="R", start=4015.0)
    out = spectra.join_arms(frame(blue + gap, PIX), order=["B", "R"])
    assert [r["wave"] for r in sorted(out.collect(), key=lambda r: r["wave"])] == [4000.0 + i for i in range(25)]
    assert sum(r["ivar"] == 0 for r in out.collect()) == 5
    over = spectrum([3.0] * 10, [3.0] * 10, arm="R", start=4006.0)
    mixed = {r["wave"]: r for r in spectra.join_arms(frame(blue + over, PIX), order=["B", "R"], max_jump=0.9).collect()}
    assert mixed[4007.0]["flux"] == pytest.approx((1 + 9) / 4) and mixed[4007.0]["ivar"] == pytest.approx(4.0)
    bad = {r["wave"]: r for r in spectra.join_arms(frame(blue + over, PIX), order=["B", "R"], bad_mask=(4000.0, 4003.0)).collect()}
    assert bad[4007.0]["flux"] == 0 and bad[4002.0]["ivar"] == 0 and bad[4004.0]["ivar"] == 1
    third = spectrum([1.0] * 5, arm="G", start=4015.0)
    assert spectra.join_arms(frame(blue + over + third, PIX), order=["B", "R", "G"]).count() == 20


def test_rebin_keeps_flux(frame):
    n = 50
    rows = [(1, "B", i, math.log(4000) + i * 0.001, 1.0 + i % 3) for i in range(n)]
    df = frame(rows, "spec_id int, arm string, pix int, logw double, flux double")
    old = df.select("spec_id", (F.col("logw") - 0.0005).alias("lo"), (F.col("logw") + 0.0005).alias("hi"), "flux")
    edge = math.log(4000) - 0.0005
    new = frame([(1, j, edge + j * 0.05 / 7, edge + (j + 1) * 0.05 / 7) for j in range(7)], "spec_id int, j int, new_lo double, new_hi double")
    out = ranges.overlap_rebin(old, new, keys=["spec_id"], new_id="j", width=0.004)
    assert out.agg(F.sum("flux")).first()[0] == pytest.approx(sum(r[4] for r in rows))


def test_interpolation_clamps_only_on_request(frame):
    c = frame([(1, 10.0, 1.0), (1, 20.0, 3.0), (1, 30.0, 3.0)], "curve_id int, wave double, value double")
    q = frame([(1, 5.0), (1, 10.0), (1, 15.0), (1, 30.0), (1, 31.0), (2, 15.0)], "curve_id int, x double")
    plain = {(r["curve_id"], r["x"]): r["value"] for r in ranges.interp_at(q, c, x="x", step=10.0).collect()}
    assert plain == {(1, 5.0): None, (1, 10.0): 1.0, (1, 15.0): 2.0, (1, 30.0): 3.0, (1, 31.0): None, (2, 15.0): None}
    held = {(r["curve_id"], r["x"]): r["value"] for r in ranges.interp_at(q, c, x="x", step=10.0, clamp=True).collect()}
    assert held[(1, 5.0)] == 1.0 and held[(1, 31.0)] == 3.0 and held[(2, 15.0)] is None


CURVE = "nspec int, wave double, value double"


def test_two_arm_curves(frame):
    blue = frame([(1, 4000.0 + 10 * i, 2.0 + 0.1 * i) for i in range(6)] + [(2, 4000.0, 1.0)], CURVE)
    red = frame([(1, 4100.0 + 10 * i, 4.0) for i in range(6)], CURVE)
    got = {r["wave"]: r["value"] for r in curves.merge_curves(blue, red, start=3990.0, stop=4160.0, step=10.0).collect()}
    assert got[3990.0] == 2.0 and got[4050.0] == pytest.approx(2.5) and got[4160.0] == 4.0
    assert got[4070.0] == pytest.approx(2.5 + 1.5 * 0.4) and got[4100.0] == 4.0


def test_missing_fibres_take_the_lower_of_two(frame):
    got = {r["nspec"]: r["copied_from"] for r in curves.fill_missing_fibres(frame([(2, 1.0, 5.0), (4, 1.0, 6.0)], CURVE), max_nspec=6).collect()}
    assert got == {1: 2, 2: None, 3: 2, 4: None, 5: 4, 6: 4}


def test_three_curve_families_do_not_mix(frame):
    rows = [(b, 4000.0 + 100 * i, {0: 1.0, 1: 3.0, 2: 6.0}[b % 3] + 0.001 * b + 0.01 * i) for b in range(60) for i in range(11)]
    df = frame(rows, "bin_id int, wave double, value double")
    for fallback in (False, True):
        member, shape = curves.curve_buckets(df, max_buckets=3, fallback=fallback)
        by = {}
        for r in member.collect():
            by.setdefault(r["bucket"], set()).add(r["bin_id"] % 3)
        assert all(len(v) == 1 for v in by.values())
    member, shape = curves.curve_buckets(df.where("bin_id < 2"), max_buckets=6)
    assert {r["bucket"] for r in member.collect()} == {0, 1} and shape.count() == 22


def test_flux_weighted_curves(frame):
    c = frame([(1, 4000.0, 2.0), (2, 4000.0, 4.0), (3, 4000.0, 100.0)], "spaxel_id int, wave double, value double")
    s = frame([(1, 0, 1.0), (2, 0, 3.0), (3, 0, -5.0), (4, 1, 2.0)], "spaxel_id int, bin_id int, signal double")
    got = {r["bin_id"]: r["value"] for r in curves.bin_curves(s, c).collect()}
    assert got == {0: 3.5}


def test_smoothing_keeps_a_constant(frame):
    flat = frame([(1, float(i), 2.0) for i in range(9)], CURVE)
    for kind in ("boxcar", "gaussian", "hanning"):
        assert [r["value"] for r in curves.smooth_curves(flat, size=5, kind=kind).collect()] == pytest.approx([2.0] * 9)


def test_bright_points_do_not_bias_the_sky(frame):
    rng = np.random.default_rng(2)
    v = rng.normal(8000, 9500, 4000)
    v[:2] = [4500 * 9500, 2500 * 9500]
    got = detect.robust_sky(frame([(float(x),) for x in v], "data double")).first()
    assert abs(got["level"] - 8000) < 800 and abs(got["rms"] - 9500) < 500 and 0 < got["rejected"] < 0.2


def test_noise_only_calibration_fails(frame):
    rng = np.random.default_rng(4)
    v = rng.normal(0, 1, 2000)
    side = lambda x: frame([(float(a),) for a in x], "snr double")
    scan = detect.purity_scan(side(v), side(-v), thresholds=[1.0, 1.5, 2.0, 2.5])
    assert detect.choose_threshold(scan, target=0.9, min_n=5, floor=1.0).first()["min_snr"] is None
    real = detect.purity_scan(side(list(v) + [9.0] * 40), side(-v), thresholds=[2.0, 5.0])
    assert detect.choose_threshold(real, target=0.9, min_n=15, floor=6.0).first()["min_snr"] == 6.0


def test_matched_filter_peaks_at_the_source(frame):
    rows = [(w, y, x, 10.0 if (w, y, x) == (5, 4, 6) else 0.0, 1.0) for w in range(10) for y in range(9) for x in range(12)]
    df = frame(rows, "iw int, iy int, ix int, data double, ivar double")
    out = detect.matched_filter(df, spectral_sigma=1.0, spatial_sigma=1.0, bounds={"iw": (0, 9), "iy": (0, 8), "ix": (0, 11)})
    top = out.orderBy(F.col("snr").desc()).first()
    assert (top["iw"], top["iy"], top["ix"]) == (5, 4, 6)
    k2 = sum(math.exp(-(o**2)) for o in range(-4, 5)) ** 3
    assert top["snr"] == pytest.approx(10.0 / math.sqrt(k2))


def test_patch_tally(frame):
    rows = [(1, "ex", "failed")] * 226 + [(2, "ex", "failed")] * 9 + [(3, "ex", "written")] + [(3, "ex", "no_valid_spaxels")] * 20
    got = {r["run"]: r for r in quality.patch_yield(frame(rows, "run int, stage string, outcome string")).collect()}
    assert got[1]["run_failed"] and not got[2]["run_failed"] and not got[3]["run_failed"]
    assert got[3]["yield"] == 0.048 and got[3]["low_yield"]


def test_job_list(frame):
    rows = [(1, "x_abc123", "TIMEOUT"), (2, "x_abc123", "COMPLETED"), (3, "x_abc123", "CANCELLED by 1000"), (4, "x_other", "TIMEOUT"), (5, "x_abc123", "OUT_OF_MEMORY")]
    got = quality.killed_jobs(frame(rows, "job_id int, name string, state string"), tag="abc123").collect()
    assert {(r["job_id"], r["state"]) for r in got} == {(1, "TIMEOUT"), (3, "CANCELLED"), (5, "OUT_OF_MEMORY")}


def test_outer_merge_keys_meet(frame):
    a = frame([(1, "x", 1.0), (None, None, 2.0)], "target_id int, cname string, va double")
    b = frame([(None, None, 5), (2, "y", 6)], "target_id int, cname string, vb int")
    out, flag = merge.outer_merge([a, b], ["target_id", "cname"])
    rows = {(r["target_id"], r["cname"]): (r["va"], r["vb"]) for r in out.collect()}
    assert rows == {(1, "x"): (1.0, None), (-999, "nan"): (2.0, 5), (2, "y"): (None, 6)} and flag == 0
    filled = {r["target_id"]: r for r in tables.fill_product(out).collect()}
    assert math.isnan(filled[2]["va"]) and filled[1]["vb"] == -1
    assert merge.outer_merge([None, b], ["target_id", "cname"])[1] == -1
    assert merge.outer_merge([a, a], ["target_id", "cname"])[0].columns == ["target_id", "cname", "va_1", "va_2"]


HINT = "target_id int, targclass string, targprog string, targsrvy string"


def test_survey_class_order(frame):
    rows = [(1, "qso star", "", ""), (2, "", "AGN survey", ""), (3, "none", "x", "AB-1"), (4, "", "", "zz-AB-2"), (5, "nan", "", "?")]
    got = classify.survey_class(frame(rows, HINT).withColumn("class", F.lit("keep")), codes=[("GALAXY", "AB"), ("QSO", "AB-1")], default="class").collect()
    assert {r["target_id"]: r["srvy_class"] for r in got} == {1: "STAR", 2: "QSO", 3: "QSO", 4: "GALAXY", 5: "keep"}


ZFIT = "target_id int, znum int, z double, zerr double, zwarn int, class string, chi2 double"


def scan_rows(t, template, z0, chi0):
    return [(t, template, i, z0 + (i - 10) * 0.005, chi0 + 4e4 * ((i - 10) * 0.005) ** 2) for i in range(21)]


def run_fallback(frame, fits, scan, hint=""):
    z = frame([(1, n, *f) for n, f in enumerate(fits)], ZFIT)
    s = frame(scan, "target_id int, template string, i int, z double, chi2 double")
    h = frame([(1, hint, "", "")], HINT)
    return {r["znum"]: r for r in classify.fallback_redshift(z, s, h).collect()}


def test_fallback_class_mismatch_swaps(frame):
    scan = scan_rows(1, "GALAXY", 0.5, 100.0) + scan_rows(1, "STAR", 0.0, 130.0)
    fits = [(0.0, 0.1, 0, "STAR", 120.0), (0.9, 0.1, 0, "GALAXY", 121.0), (0.51, 0.1, 0, "GALAXY", 122.0)]
    got = run_fallback(frame, fits, scan)
    assert got[0]["class"] == "GALAXY" and got[0]["z"] == 0.51 and got[2]["class"] == "STAR"
    assert got[0]["zwarn"] & classify.ZW_CLASS_MISMATCH and got[0]["zwarn"] & classify.ZW_SWAP_APPLIED
    assert got[0]["zwarn"] & classify.ZW_SCAN_CONFIRMS and got[1]["zwarn"] == 0
    kept = run_fallback(frame, fits, scan, hint="STAR")
    assert kept[0]["class"] == "STAR" and kept[0]["zwarn"] & classify.ZW_TARGETING_OVERRIDE


def test_fallback_second_tier_and_no_rank(frame):
    scan = scan_rows(1, "GALAXY", 0.5, 100.0)
    got = run_fallback(frame, [(0.0, 0.1, 0, "STAR", 120.0), (0.5, 0.1, 1024, "GALAXY", 121.0)], scan)
    assert got[0]["class"] == "GALAXY" and got[0]["zwarn"] & classify.ZW_MINFIT_RELAXED
    none = run_fallback(frame, [(0.0, 0.1, 0, "STAR", 120.0), (0.5, 0.1, 4, "GALAXY", 121.0)], scan)
    assert none[0]["class"] == "STAR" and none[0]["zwarn"] & classify.ZW_NO_VALID_RANK


def test_fallback_shift_ratio_and_improvement(frame):
    scan = scan_rows(1, "GALAXY", 0.5, 100.0)
    shift = run_fallback(frame, [(0.8, 0.1, 0, "GALAXY", 110.0), (0.5, 0.1, 0, "GALAXY", 120.0)], scan)
    assert shift[0]["z"] == 0.5 and shift[0]["zwarn"] & classify.ZW_Z_SHIFT
    better = run_fallback(frame, [(0.8, 0.1, 0, "GALAXY", 99.0), (0.5, 0.1, 0, "GALAXY", 120.0)], scan)
    assert better[0]["z"] == 0.8 and better[0]["zwarn"] & classify.ZW_Z_IMPROVED
    worse = run_fallback(frame, [(0.5, 0.1, 0, "GALAXY", 151.0)], scan)
    assert worse[0]["zwarn"] & classify.ZW_RATIO and worse[0]["zwarn"] & classify.ZW_NO_VALID_RANK
    pair = run_fallback(frame, [(0.505, 0.1, 0, "QSO", 110.0)], scan)
    assert not pair[0]["zwarn"] & classify.ZW_CLASS_MISMATCH


def test_parabola_vertex(frame):
    scan = [(1, "STAR", i, 0.1 + 0.004 * i, 50 + 3000 * (0.1 + 0.004 * i - 0.1213) ** 2) for i in range(12)]
    got = classify.refine_minimum(frame(scan, "target_id int, template string, i int, z double, chi2 double")).first()
    assert got["z_fit"] == pytest.approx(0.1213) and got["chi2_fit"] == pytest.approx(50) and got["reliable"]
    assert got["z_sigma"] == pytest.approx(1 / math.sqrt(3000))
    few = classify.refine_minimum(frame(scan[:3], "target_id int, template string, i int, z double, chi2 double")).first()
    assert not few["reliable"] and few["z_fit"] == few["z_scan"]


def test_best_grid_rules(frame):
    rows = [(1, 1, 5.0, 3500.0, 3500.0), (1, 2, 4.0, 3520.0, 3500.0), (1, 3, -1000.0, 9000.0, 3500.0), (1, 4, 6.0, 9000.0, 1.0), (2, 5, 7.0, 9000.0, 1.0)]
    df = frame(rows, "obj_id int, grid int, chi2 double, teff double, teff_limit double")
    assert {r["obj_id"]: r["grid"] for r in classify.best_grid(df).collect()} == {1: 1, 2: 5}
    with pytest.raises(ValueError):
        classify.best_grid(df.where("grid < 3"))


def test_patch_checks_report_missing_columns(frame):
    p = frame([(1, 0.0, 1.0, "T")], "patch_id bigint, a double, b double, type string")
    r = frame([(1, 0, "STAR", None, 0.0, 4)], "patch_id bigint, rank int, class string, z double, zerr double, zwarn int")
    got = {x["rule"] for x in patches.patch_checks(p, r, wanted=["GALAXY"]).collect()}
    assert {"missing_column:ra", "no_redshift", "redshift_warning", "zero_size", "no_wanted_class"} <= got


def test_product_round_trip(spark, frame, tmp_path):
    t = frame([(7, 1, None, None), (8, 2, 2.5, "a")], "obs_id int, target_id int, z double, name string")
    paths = tables.write_product({"class_table": t}, str(tmp_path), "20240101")
    back = {r["obs_id"]: r for r in spark.read.parquet(paths[0]).collect()}
    assert math.isnan(back[7]["z"]) and back[7]["name"] == "nan" and back[8]["z"] == 2.5
    assert tables.export_csv(t, str(tmp_path / "csv"), ["target_id", "absent"], {"target_id": "id"})
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["id"]
    assert not tables.export_csv(t.limit(0), str(tmp_path / "none"), ["target_id"])
