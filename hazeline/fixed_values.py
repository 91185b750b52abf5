"""Tokens, names, coefficients and patterns that results depend on.

Everything here is plain data taken as given; no logic.
"""

from __future__ import annotations

# Text cells that mean "missing".
NA_TOKENS = ("NA", "", " ", "-", "-999", "-999.000")

# Sample codes of test blanks and field blanks.
BLANK_CODES = ("TB", "FB")

# Hourly files: column layout after the optional method column is gone.
HOURLY_ID_COLUMNS = (
    "pollutant", "napsid", "city", "p_t", "latitude", "longitude", "date",
)
HOUR_COLUMNS = tuple(f"h{h:02d}" for h in range(1, 25))
HOURLY_COLUMNS = HOURLY_ID_COLUMNS + HOUR_COLUMNS
HOURLY_MAX_FIELDS = 32
HOURLY_HEADER_MARK = "Pollut"
METHOD_HEADERS = (
    "Method",
    "Method Code//Code Méthode",
    "Method Code // Code Méthode",
)
HOURLY_POLLUTANTS = ("CO", "NO", "NO2", "NOX", "O3", "PM10", "PM25", "PM2.5", "SO2")

# Sheet grids: header rows and the special rows above them.
GRID_HEADER_PATTERN = "(?i)NAPS|Date"
MEDIUM_MARK = "Medium"
SAMPLER_MARK = "Sampler"
MEDIUM_SHEET = "Ions-Spec_IC"
SAMPLER_INFO_MARK = "Sampler #"
FILE_REJECT_PATTERN = "(?i)FR|4hr|change|csv|[/]$"
SHEET_REJECT_PATTERN = "(?i)metadata|change|csv|station"
SPREADSHEET_EPOCH = "1899-12-30"

# Column-name fragments of text columns; everything else is numeric.
TEXT_COLUMN_FRAGMENTS = (
    "sample_type", "sampling_type", "c_f", "cart", "cartridge", "media",
    "f_c", "fraction", "naps", "date", "flag", "time", "x0", "id", "na",
)

# Pre-2010 carbon columns spread by cartridge.
CARBON_VALUES = (
    "speciation_mass_ug_m3", "oc1", "oc2", "oc3", "oc4", "poc_r", "poc_t",
    "oc_r", "oc_t", "ec1", "ec2", "ec3", "ec_t", "ec_r", "tc", "oc_dl", "ec_dl",
)

# Columns under a wrong header: (station, file type, name found, name meant).
COLUMN_FIXES = (
    ("S60211", "CARB", "mas_sp", "speciation_mass_ug_m3"),
    ("S70301", "WICPMS", "mass", "mass_ug_m3"),
    ("S105001", "WICPMS", "mass", "mass_ug_m3"),
    ("S106600", "WICPMS", "mass", "mass_ug_m3"),
)
# The cartridge stands in an unnamed column.
CARTRIDGE_IN_X0 = (("S60427", "CARB"),)
# Columns to ignore: (station, file type, name prefix).
COLUMNS_DROPPED = (("S100702", "ICPMS", "na"),)

# Seasons by month: four seasons and two half-years.
SEASON_MONTHS = {
    "spring": (3, 4, 5),
    "summer": (6, 7, 8),
    "fall": (9, 10, 11),
    "winter": (12, 1, 2),
}
WARM_HALF_MONTHS = (4, 9)

# Mass reconstruction coefficients.
NITRATE_TO_ANO3 = 1.29
NITRATE_IN_ASO4 = 0.29
SOIL_COEFFICIENTS = {
    "silicon_si": 3.48,
    "calcium_ca": 1.63,
    "iron_fe": 1.63,
    "potassium_k": 1.41,
    "titanium_ti": 1.94,
}
WATER_FACTOR = 0.32
COMPONENTS = ("NaCl", "SOIL", "EC", "OM", "ANO3", "ASO4", "PBW")

# Columns of the fine table that the analysis uses.
ANALYSIS_COLUMNS = (
    "ions_ic_spec_tf_nitrate", "ions_ic_spec_tf_sulphate", "ions_ic_spec_tf_ammonium",
    "ocec_spec_oc_b", "ocec_spec_oc_corr", "ions_ic_spec_tf_potassium",
    "ocec_spec_tc_corr", "ocec_spec_ec_a", "ocec_spec_ec_b",
    "ions_ic_spec_tf_sodium", "ions_ic_spec_tf_chloride", "ammonia_ic_spec_ammonia",
    "edxrf_spec_silicon_si", "edxrf_spec_calcium_ca", "edxrf_spec_iron_fe",
    "edxrf_spec_titanium_ti", "edxrf_spec_potassium_k", "ocec_spec_oc_a",
    "nitrate_ic_spec_nitrate", "edxrf_dich_silicon_si", "edxrf_dich_calcium_ca",
    "edxrf_dich_iron_fe", "edxrf_dich_potassium_k", "edxrf_dich_titanium_ti",
    "ocec_spec_oc_r_a", "ocec_spec_oc_r_b", "fb_ocec_spec_poc_b",
    "fb_ocec_spec_oc_r", "fb_ocec_spec_oc_b", "spec_sulphur_dioxide",
    "acidic_ic_spec_sulphur_dioxide", "spec_nitric_acid",
    "acidic_ic_spec_nitric_acid", "spec_temp", "spec_hum", "spec_pres",
    "spec_ws", "spec_wd", "spec_tdp",
)
WEATHER_COLUMNS = ("spec_temp", "spec_hum", "spec_pres", "spec_ws", "spec_wd", "spec_tdp")

# Stations of the study, their cities, and the output order of the cities.
STUDY_STATIONS = (
    ("S30113", "Halifax"), ("S40801", "Canterbury"), ("S50104", "Montréal"),
    ("S54401", "Saint-Anicet"), ("S60211", "Windsor"), ("S60427", "Toronto"),
    ("S62601", "Simcoe"), ("S90132", "Edmonton"), ("S103202", "Golden"),
    ("S101004", "Abbotsford"), ("S100119", "Burnaby"),
)
CITY_ORDER = (
    "Halifax", "Canterbury", "Montréal", "Saint-Anicet", "Toronto", "Simcoe",
    "Windsor", "Edmonton", "Golden", "Abbotsford", "Burnaby",
)

# Periods in which a successor station is left out (station, from, to; null = open).
STATION_EXCLUSIONS = (
    ("S50134", "2008-01-01", "2008-12-31"),
    ("S60439", None, "2014-05-26"),
)
# Single observations known to be wrong.
BAD_OBSERVATIONS = (("Edmonton", "2018-03-12"),)

# Published sample counts per station, for the comparison table.
PUBLISHED_COUNTS = (
    ("S30113", 177), ("S40801", 346), ("S50104", 554), ("S54401", 664),
    ("S60211", 267), ("S60427", 565), ("S62601", 311), ("S90132", 333),
    ("S103202", 251), ("S101004", 537), ("S100119", 695),
)

# Candidate dates of the splitting-date search.
SPLIT_FIRST, SPLIT_LAST, SPLIT_STEP_MONTHS = "2007-01-01", "2016-01-01", 6

# Centre and radius of the radius study.
STUDY_CENTRE = (44.3091, -78.3197)
STUDY_RADIUS_KM = 150.0
EARTH_RADIUS_KM = 6371.0

# Box-plot quantiles and notch factor.
BOX_PROBS = (0.02, 0.25, 0.5, 0.75, 0.98)
NOTCH_FACTOR = 1.58

# Prefix rules of the canonical names: (prefix in the old name, new prefix).
CANONICAL_PREFIXES = (
    ("Metals_ICPMS_WS_", "na.ICPMS_WS.TF."),
    ("Metals_ICPMS_WS_dich_", "dich.ICPMS_WS.TF."),
    ("Metals_ICPMS_WS_spec_", "spec.ICPMS_WS.TF."),
    ("Metals_ICPMS_NT_", "na.ICPMS_NT.TF."),
    ("Metals_ICPMS_NT_dich_", "dich.ICPMS_NT.TF."),
    ("Metals_ICPMS_NT_spec_", "spec.ICPMS_NT.TF."),
    ("Ions_IC_", "na.IC.na."),
    ("Ions_IC_tf_", "na.IC.TF."),
    ("Ions_IC_nf_", "na.IC.NF."),
    ("Ions_IC_dich_", "dich.IC.na."),
    ("Ions_IC_dich_tf_", "dich.IC.TF."),
    ("Ions_IC_dich_nf_", "dich.IC.NF."),
    ("Ions_IC_spec_", "spec.IC.na."),
    ("Ions_IC_spec_tf_", "spec.IC.TF."),
    ("Ions_IC_spec_nf_", "spec.IC.NF."),
    ("EDXRF_", "na.EDXRF.TF."),
    ("EDXRF_dich_", "dich.EDXRF.TF."),
    ("EDXRF_spec_", "spec.EDXRF.TF."),
    ("Nitrate_IC_spec_", "spec.V_IC.NF."),
    ("OCEC_spec_", "spec.TOR.QF."),
    ("Biomass_IC_spec_", "spec.IC.TF."),
    ("Ammonia_IC_spec_", "spec.IC.CAD."),
    ("Acidic_IC_spec_", "spec.IC.SCD."),
)

# Limit columns found by hand: value name -> limit name.
LIMIT_OVERRIDES = {
    "EDXRF_dich_sulphur_s": "EDXRF_dich_s_mdl",
    "Ions_IC_spec_nf_manganese": "Ions_IC_spec_nf_mn_mdl",
    "Ions_IC_spec_tf_manganese": "Ions_IC_spec_tf_mn_mdl",
}
# Limit columns renamed by hand: old name -> new name.
LIMIT_RENAMES = {
    "EDXRF_dich_ni_mdl": "EDXRF_dich_nickel_ni_mdl",
    "EDXRF_s_mdl": "EDXRF_sulphur_s_mdl",
    "EDXRF_spec_s_mdl": "EDXRF_spec_sulphur_s_mdl",
    "EDXRF_spec_ni_mdl": "EDXRF_spec_nickel_ni_mdl",
    # stays as it is, whatever value names it is found for
    "Acidic_IC_spec_sulphur_dioxide_mdl": "Acidic_IC_spec_sulphur_dioxide_mdl",
}
# Canonical names set by hand after the rules.
CANONICAL_OVERRIDES = {"dich_pm2_5_mdl": "dich.pm2_5_mdl"}
