"""Fixed values of the safety rules.

Everything here is data that results depend on: thresholds, weights, valid ranges, defaults,
labels and message texts. Logic lives in ``functions`` and ``operators``.
"""

# Alert thresholds per sensor, (warning, critical); a reading at the threshold counts.
THRESHOLDS = {
    "methane_ppm": (50.0, 150.0),
    "lpg_ppm": (80.0, 200.0),
    "co2_ppm": (1000.0, 2000.0),
    "smoke_level": (20.0, 45.0),
    "aqi": (100.0, 150.0),
    "co_ppm": (9.0, 35.0),
    "temperature_c": (42.0, 55.0),
}

# Points a sensor at its critical threshold adds to the risk score; they sum to 100.
RISK_WEIGHTS = {
    "methane_ppm": 35.0,
    "lpg_ppm": 20.0,
    "smoke_level": 20.0,
    "co_ppm": 10.0,
    "aqi": 10.0,
    "co2_ppm": 3.0,
    "temperature_c": 2.0,
}

# Multiplier per house risk profile; any other profile counts 1.0.
PROFILE_FACTORS = {"low": 0.85, "medium": 1.0, "high": 1.15}
MAX_RISK = 100.0

# Cleaning ranges (outside becomes NULL) and replacements for NULL.
VALID_RANGES = {"temperature_c": (-10, 65), "humidity_pct": (0, 100), "aqi": (0, 500)}
DEFAULTS = {
    "temperature_c": 25.0,
    "humidity_pct": 50.0,
    "methane_ppm": 0.0,
    "lpg_ppm": 0.0,
    "co_ppm": 0.0,
    "smoke_level": 0.0,
    "aqi": 50,
    "co2_ppm": 400,
    "pm25_ugm3": 10.0,
    "pm10_ugm3": 20.0,
}
REFERENCE_YEAR = 2026

# Cleaned-layer flags (strictly above) and risk buckets (at or above).
GAS_LEAK_METHANE, GAS_LEAK_LPG = 350, 300
FIRE_TEMPERATURE, FIRE_SMOKE = 50, 50
POLLUTION_AQI = 150
RISK_BUCKETS = ((70, "CRITICAL"), (40, "HIGH"), (20, "MEDIUM"))

# Mean risk from which a calm region is MEDIUM; a governorate's counts for its levels.
ZONE_MEDIUM_RISK = 15.0
GOV_MEDIUM_RISK = 12.0
GOV_CRITICAL_AT, GOV_WARNING_AT = 2, 3

# Root cause, first match wins.
ROOT_CAUSES = (("methane_ppm", 50, "GAS_LEAK"), ("temperature_c", 42, "HIGH_TEMP"), ("smoke_level", 20, "SMOKE_SPIKE"))
OTHER_CAUSE = "ELEVATED_RISK"
CAUSE_SENSOR = {"GAS_LEAK": "methane", "HIGH_TEMP": "temperature", "SMOKE_SPIKE": "smoke", "CO_HAZARD": "co"}

# Display bands.
MAP_SEVERITY = {"CRITICAL": 100, "WARNING": 50}
RISK_BANDS = ((12, "RED"), (8, "ORANGE"))
METHANE_BANDS = ((150, "CRITICAL"), (50, "WARNING"))
ELEVATED_RISK = 8
PLAUSIBLE_METHANE = (0, 2000)
BANNER_WARNINGS = 5

# Fleet size when none is given, governorates named in the banner.
MONITORED_HOUSES = 3000
GOVERNORATE_COUNT = 27

# Banner and snapshot-report texts.
BANNER_CRITICAL = (
    "CRITICAL: %d nodes at risk. Highest cluster: %s (avg risk %s). Immediate response required."
)
BANNER_WARNING = "WARNING: %d nodes elevated. %d governorate%s above threshold. Highest: %s (avg risk %s)."
BANNER_STABLE = (
    f"STABLE: All {GOVERNORATE_COUNT} governorates within normal parameters. "
    "Avg risk %s/100. Highest: %s (%s)."
)
REPORT_TITLE = "=== LIVE SYSTEM SNAPSHOT ==="
REPORT_HOUSES = "Total monitored houses : %d"
REPORT_CRITICAL = "Critical threats       : %d"
REPORT_WARNING = "Warning signals        : %d"
REPORT_RISK = "Average risk score     : %.1f / 100"
REPORT_NORMAL = "Normal houses          : %d"
REPORT_TOP_CRITICAL = "--- TOP CRITICAL INCIDENTS ---"
REPORT_TOP_WARNING = "--- TOP WARNING INCIDENTS ---"
REPORT_INCIDENT = (
    "  [%s] %s | %s/%s | Risk=%.1f | CH4=%.1fppm | Temp=%.1fC | Smoke=%.1f | CO=%.1fppm | Cause=%s"
)
REPORT_RANKING = "--- GOVERNORATE RISK RANKING (all, ordered by avg_risk_score DESC) ---"
REPORT_GOVERNORATE = "  %s: avg_risk=%.1f | critical=%d | warning=%d | level=%s"
REPORT_TREND = "--- METHANE TREND (last 3 min, newest first) ---"
REPORT_TREND_VALUES = "  Values: [%s]  |  Direction: %s"

# Zone names in the two raised risk tiers; every other zone is low.
HIGH_RISK_ZONES = (
    "Shubra", "Imbaba", "Matareyya", "Ain Shams", "Bulaq Dakrour", "Haram", "Faisal", "Mahalla El Kubra",
    "Shubra El Kheima", "10th of Ramadan", "Kafr El Dawwar", "Borg El Arab", "Tel El Kebir", "Ataka", "Suez City",
)
MEDIUM_RISK_ZONES = (
    "Nasr City", "Dokki", "Mohandessin", "Tanta", "Mansoura", "Zagazig", "Banha", "Damanhour", "Kafr El Sheikh",
    "Ismailia City", "Port Fouad", "Fayoum City", "Asyut City", "Sohag City", "Qena City", "Minya City",
)

# Governorate, centre latitude and longitude, then its bounds lat_min, lat_max, lon_min, lon_max.
GOVERNORATES = (
    ("Cairo", 30.0444, 31.2357, 29.70, 30.30, 31.10, 31.85),
    ("Giza", 29.9870, 31.2118, 29.20, 30.20, 30.70, 31.40),
    ("Alexandria", 31.2001, 29.9187, 30.80, 31.40, 29.40, 30.20),
    ("Qalyubia", 30.3292, 31.2170, 30.15, 30.35, 31.15, 31.30),
    ("Sharqia", 30.7444, 31.7000, 30.50, 30.75, 31.50, 31.80),
    ("Dakahlia", 31.0364, 31.3807, 30.90, 31.15, 31.30, 31.60),
    ("Gharbia", 30.8748, 31.0326, 30.75, 30.95, 30.90, 31.10),
    ("Monufia", 30.5972, 30.9876, 30.40, 30.65, 30.85, 31.10),
    ("Beheira", 30.8480, 30.3436, 30.70, 31.00, 30.10, 30.50),
    ("Kafr El Sheikh", 31.1107, 30.9388, 31.00, 31.20, 30.80, 31.00),
    ("Damietta", 31.4165, 31.8133, 31.35, 31.45, 31.75, 31.85),
    ("Port Said", 31.2653, 32.3019, 31.20, 31.25, 32.25, 32.33),
    ("Ismailia", 30.5965, 32.2715, 30.50, 30.65, 32.20, 32.35),
    ("Suez", 29.9668, 32.5498, 29.90, 30.00, 32.45, 32.55),
    ("South Sinai", 28.2134, 33.9000, 27.90, 29.00, 33.40, 34.50),
    ("North Sinai", 30.9117, 33.7722, 30.50, 31.30, 32.60, 34.20),
    ("Fayoum", 29.3084, 30.8428, 29.10, 29.50, 30.40, 31.00),
    ("Beni Suef", 29.0661, 31.0994, 28.90, 29.20, 30.80, 31.20),
    ("Minya", 28.0871, 30.7618, 27.90, 28.30, 30.50, 31.00),
    ("Asyut", 27.1783, 31.1859, 27.00, 27.40, 31.00, 31.40),
    ("Sohag", 26.5569, 31.6948, 26.30, 26.80, 31.40, 31.90),
    ("Qena", 26.1551, 32.7160, 25.90, 26.30, 32.40, 32.90),
    ("Luxor", 25.6872, 32.6396, 25.50, 25.80, 32.50, 32.80),
    ("Aswan", 24.0889, 32.8998, 23.90, 24.30, 32.70, 33.10),
    ("Red Sea", 26.9670, 33.8000, 25.00, 27.20, 33.50, 34.90),
    ("New Valley", 25.4473, 30.5580, 24.00, 26.00, 29.90, 31.00),
    ("Matruh", 31.3543, 27.2373, 30.50, 31.40, 26.50, 28.50),
)
