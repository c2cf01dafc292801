"""Constants of the model. Results depend on each of them."""

from __future__ import annotations

HEX_KM2 = {8: 0.737327598, 9: 0.105332513, 10: 0.015047502}
STEP_DB = 5.0
BAND_DBM = {1: -105.0, 2: -95.0, 3: -85.0}
MIN_REACH_M = 3000.0
ATTRIBUTION_MARGIN = 1.6
MATCH_RADIUS_M, SNAP_RADIUS_M, AMBIGUITY = 2000.0, 750.0, 1.5
FRINGE_M = 80_000.0
BOUNDARY_SNAP_M = 1500.0
EPS = 1e-9
DAMP_REFERENCE = 0.05
MAX_INFLUENCE = 0.25
WEIGHTS = {
    "added_frac_of_county": 0.25,
    "coverage_increase_magnitude": 0.10,
    "blanket_fillin": 0.14,
    "same_site_growth_share": 0.22,
    "unattributed_share": 0.0,
    "boundary_snap_share": 0.08,
    "new_site_share": -0.22,
    "asr_no_new_structure": 0.0,
}
RANGES = {"added_frac_of_county": 0.15, "signal_jump_implausibility": 20.0}
MIN_ADDED_KM2, SAME_SITE, COUNTY_FRACTION, BLANKET, UNATTRIBUTED = 10.0, 0.50, 0.075, 0.20, 1.01
NEW_SHARE, CROSS_SHARE = 0.50, 0.35
SEVERITY = ((0.99, "Top 1%"), (0.95, "Top 5%"), (0.90, "Top 10%"))
LEGACY_SEVERITY = ((0.70, "Top 1%"), (0.55, "Top 5%"), (0.40, "Top 10%"))
#: Least and greatest hue, least saturation and value of coverage on a rendered map; signal by saturation x value.
GREEN = (0.20, 0.45, 0.20)
GREEN_DBM = ((0.85, -85.0), (0.55, -95.0), (0.0, -105.0))
#: Names that a column may arrive under, the first one found counts. Fixed values, in this order.
SIGNAL_NAMES = ("minsignal", "min_signal", "signal", "sig_strength", "signalstr")
GEOMETRY_NAMES = ("geometry_wkt", "wkt", "geom_wkt", "the_geom", "geometry", "geom", "shape")
TIERS = ((50, "red"), (100, "orange"), (150, "yellow"), (250, "green"))
CORE_TARGET, CORE_LOW, CORE_HIGH = 0.35, 0.18, 0.60
GRACE_DAYS = 90
MIN_TESTS = 3
FIXTURE_STATE = "90"
#: Site inference: peaks, lobes of several sectors, lobe reach, kinds of sites.
DEPTH_CAP, PEAK_DEPTH, PROMINENCE_RINGS = 40, 2.0, 3.0
SPLIT_RANGE_DB, PEAK_RANGE_DB, PROMINENCE_DB = 5.0, 10.0, 3.0
LARGE_BLOB_CELLS, LARGE_BLOB_M = 4000, 2000.0
PETAL_MIN_M, PETAL_MAX_M = 1500.0, 10_000.0
SECTOR_BINS = 18
SECTOR_CELLS = {2: 18, 3: 24}
SECTOR_SHARE = {2: (0.18, 0.80), 3: (0.28, 0.90)}
LOBE_FALLBACK, LOBE_CELLS = 2.5, 3
NEW_CELLS, GROWTH = 2, 0.20
