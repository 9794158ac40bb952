"""Case analytics: volume, spikes, attribution, durations, repeat contact, profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseworks.operators import contacts, durations as ttr, incidents, profile
from caseworks.operators.splits import sample_exact
from caseworks.queries.common import DOCLABELS_SQL, DURATIONS_SQL, durations, labelled_documents, r6, table

THEMES = ["click", "error", "purchase", "signup", "view"]


def theme_spikes(spark, sf):
    return incidents.theme_spikes(table(spark, sf, "events"), "ts", "event_type", z=2.0, top=20)


def daily_volume(spark, sf):
    return incidents.daily_volume(table(spark, sf, "events"), "ts")


def daily_theme_counts(spark, sf):
    return incidents.daily_theme_counts(table(spark, sf, "events"), "ts", "event_type")


def daily_theme_matrix(spark, sf):
    return incidents.daily_theme_matrix(table(spark, sf, "events"), "ts", "event_type", THEMES)


def daily_theme_dense(spark, sf):
    return incidents.daily_theme_dense(table(spark, sf, "events"), "ts", "event_type")


def incident_attribution(spark, sf):
    found = incidents.incident_attribution(table(spark, sf, "events"), "ts", "event_type", "2024-01-10", "2024-01-16")
    return found.withColumn("incident_share", r6("incident_share"))


def incident_attribution_whole_days(spark, sf):
    found = incidents.incident_attribution(
        table(spark, sf, "events"), "ts", "event_type", "2024-01-10", "2024-01-16", whole_days=True
    )
    return found.withColumn("incident_share", r6("incident_share"))


def missingness(spark, sf):
    found = profile.missingness(labelled_documents(spark, sf, "text", "lang", "source"), top=15)
    return found.withColumn("missing", r6("missing"))


def value_counts_blank(spark, sf):
    return profile.value_counts(labelled_documents(spark, sf), "quality", top=15)


def value_counts_origin(spark, sf):
    return profile.value_counts(table(spark, sf, "documents"), "source", blank=False)


def target_profile(spark, sf):
    return profile.target_profile(labelled_documents(spark, sf), "quality")


def target_profile_many(spark, sf):
    """More classes than sample values: all of them are counted."""
    return profile.target_profile(table(spark, sf, "part"), "p_brand")


def describe_hours(spark, sf):
    found = profile.describe_exact(durations(spark, sf), ["open_hours"])
    return found.select("column", "count", *[r6(c).alias(c) for c in found.columns[2:]])


def share_zero_hours(spark, sf):
    return profile.share_equal(durations(spark, sf), "open_hours", 0.0, null_as=0.0).select(r6("share").alias("share"))


def hours_histogram(spark, sf):
    found = profile.histogram(ttr.valid_durations(durations(spark, sf)), "open_hours", 60)
    return found.select("bin", r6("low").alias("low"), r6("high").alias("high"), "count")


def text_length_summary(spark, sf):
    docs = table(spark, sf, "documents").select(F.length("text").alias("text_length"))
    found = profile.describe_exact(docs, ["text_length"])
    return found.select("column", "count", *[r6(c).alias(c) for c in found.columns[2:]])


def ttr_by_theme(spark, sf):
    found = ttr.ttr_by_theme(durations(spark, sf), "theme")
    return found.select("theme", "tickets", *[r6(c).alias(c) for c in ("mean", "p50", "p90", "p95")])


def ttr_top_p90(spark, sf):
    return ttr.ttr_top_p90(durations(spark, sf), "theme").withColumn("p90", r6("p90"))


def duration_gaps(spark, sf):
    found = ttr.duration_gaps(durations(spark, sf), "opened_at", "closed_at")
    return found.select("valid_rows", r6("opened_missing").alias("opened_missing"), r6("closed_missing").alias("closed_missing"))


def _contacts(spark, sf, days):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    return contacts.repeat_contacts(events, "user_id", "ts", "event_id", days)


def repeat_contacts(spark, sf):
    return _contacts(spark, sf, 7).select("event_id", r6("hours_since_prev").alias("hours_since_prev"), "is_repeat")


def repeat_rate(spark, sf):
    return contacts.repeat_rate(_contacts(spark, sf, 1)).select(r6("repeat_rate").alias("repeat_rate"))


def repeat_by_theme(spark, sf):
    found = contacts.repeat_by_theme(_contacts(spark, sf, 1), "event_type")
    return found.withColumn("repeat_rate", r6("repeat_rate"))


def sample_exact_500(spark, sf):
    return sample_exact(table(spark, sf, "events"), "event_id", 500).select("event_id", "event_type", "value")


_DAILY = "SELECT CAST(ts AS DATE) AS day, event_type AS theme, count(*) AS n FROM events GROUP BY 1, 2"
_GRID = f"""
c AS ({_DAILY}),
g AS (
  SELECT d.day, t.theme, coalesce(c.n, 0) AS n
  FROM (SELECT DISTINCT day FROM c) d CROSS JOIN (SELECT DISTINCT theme FROM c) t
  LEFT JOIN c ON c.day = d.day AND c.theme = t.theme
)"""


def _attribution_sql(incident: str, baseline: str) -> str:
    return f"""
WITH a AS (
  SELECT event_type AS theme, count(*) FILTER ({incident}) AS incident, count(*) FILTER ({baseline}) AS baseline
  FROM events GROUP BY 1
)
SELECT theme, incident, baseline, incident - baseline AS delta,
       round(incident / (SELECT sum(incident) FROM a)::DOUBLE, 6) AS incident_share
FROM a WHERE incident + baseline > 0
ORDER BY incident / (SELECT sum(incident) FROM a)::DOUBLE DESC, delta DESC, theme"""


_REPEAT = """
h AS (
  SELECT event_id, event_type AS theme,
         date_diff('microsecond', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) / 3.6e9 AS hours
  FROM events
)"""

_SUMMARY = """count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
       round(min({c})::DOUBLE, 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
       round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c})::DOUBLE, 6) AS max"""

_TTR = f"""
WITH {DURATIONS_SQL}
SELECT theme, count(*) AS tickets, round(avg(open_hours), 6) AS mean, round(quantile_cont(open_hours, 0.5), 6) AS p50,
       round(quantile_cont(open_hours, 0.9), 6) AS p90, round(quantile_cont(open_hours, 0.95), 6) AS p95
FROM dur WHERE open_hours >= 0 GROUP BY theme ORDER BY tickets DESC, theme"""

_MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing FROM dl"
    for c in ("doc_id", "text", "lang", "source", "quality", "toxic")
)

QUERIES = {
    "theme_spikes": (
        theme_spikes,
        f"""
WITH {_GRID},
s AS (SELECT *, avg(n) OVER (PARTITION BY theme) AS m, stddev_samp(n) OVER (PARTITION BY theme) AS sd FROM g)
SELECT theme, day, CAST(n AS BIGINT) AS count, round((n - m) / sd, 2) AS zscore
FROM s WHERE sd > 0 AND (n - m) / sd >= 2.0
ORDER BY zscore DESC, count DESC, theme, day LIMIT 20""",
    ),
    "daily_volume": (daily_volume, "SELECT CAST(ts AS DATE) AS day, count(*) AS count FROM events WHERE ts IS NOT NULL GROUP BY 1"),
    "daily_theme_counts": (daily_theme_counts, f"SELECT day, theme, n AS count FROM ({_DAILY})"),
    "daily_theme_matrix": (
        daily_theme_matrix,
        "SELECT CAST(ts AS DATE) AS day, "
        + ", ".join(f"count(*) FILTER (event_type = '{t}') AS {t}" for t in THEMES)
        + " FROM events GROUP BY 1",
    ),
    "daily_theme_dense": (daily_theme_dense, f"WITH {_GRID} SELECT day, theme, CAST(n AS BIGINT) AS count FROM g"),
    "incident_attribution": (
        incident_attribution,
        _attribution_sql(
            "ts >= TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-16'",
            "ts >= TIMESTAMP '2024-01-03' AND ts <= TIMESTAMP '2024-01-09'",
        ),
    ),
    "incident_attribution_whole_days": (
        incident_attribution_whole_days,
        _attribution_sql(
            "ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-17'",
            "ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-10'",
        ),
    ),
    "missingness": (missingness, f"WITH {DOCLABELS_SQL} {_MISSING}"),
    "value_counts_blank": (
        value_counts_blank,
        f"WITH {DOCLABELS_SQL} SELECT coalesce(CAST(quality AS VARCHAR), '(blank)') AS value, count(*) AS count "
        "FROM dl GROUP BY 1 ORDER BY count DESC, value LIMIT 15",
    ),
    "value_counts_origin": (
        value_counts_origin,
        "SELECT source AS value, count(*) AS count FROM documents WHERE source IS NOT NULL GROUP BY 1",
    ),
    "target_profile": (
        target_profile,
        f"""
WITH {DOCLABELS_SQL},
v AS (SELECT CAST(quality AS VARCHAR) AS value, count(*) AS n FROM dl GROUP BY 1),
top AS (SELECT * FROM v WHERE value IS NOT NULL ORDER BY n DESC, value LIMIT 10)
SELECT 'quality' AS target, CAST((SELECT sum(n) FROM v) AS BIGINT) AS rows,
       (SELECT count(value) FROM v) AS classes,
       CAST((SELECT coalesce(sum(n), 0) FROM v WHERE value IS NULL) AS BIGINT) AS missing,
       (SELECT '{{' || string_agg('"' || value || '":' || n, ',' ORDER BY n DESC, value) || '}}' FROM v WHERE value IS NOT NULL) AS class_counts,
       (SELECT string_agg(value, ',' ORDER BY n DESC, value) FROM top) AS sample_values""",
    ),
    "target_profile_many": (
        target_profile_many,
        """
WITH v AS (SELECT p_brand AS value, count(*) AS n FROM part GROUP BY 1),
top AS (SELECT * FROM v WHERE value IS NOT NULL ORDER BY n DESC, value LIMIT 10)
SELECT 'p_brand' AS target, CAST((SELECT sum(n) FROM v) AS BIGINT) AS rows,
       (SELECT count(value) FROM v) AS classes,
       CAST((SELECT coalesce(sum(n), 0) FROM v WHERE value IS NULL) AS BIGINT) AS missing,
       (SELECT '{' || string_agg('"' || value || '":' || n, ',' ORDER BY n DESC, value) || '}' FROM v WHERE value IS NOT NULL) AS class_counts,
       (SELECT string_agg(value, ',' ORDER BY n DESC, value) FROM top) AS sample_values""",
    ),
    "describe_hours": (
        describe_hours,
        f"WITH {DURATIONS_SQL} SELECT 'open_hours' AS \"column\", {_SUMMARY.format(c='open_hours')} FROM dur",
    ),
    "share_zero_hours": (
        share_zero_hours,
        f"WITH {DURATIONS_SQL} SELECT round(avg(CASE WHEN coalesce(open_hours, 0) = 0 THEN 1.0 ELSE 0.0 END), 6) AS share FROM dur",
    ),
    "hours_histogram": (
        hours_histogram,
        f"""
WITH {DURATIONS_SQL},
v AS (SELECT open_hours AS x FROM dur WHERE open_hours >= 0),
b AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
k AS (SELECT least(CAST(floor((x - lo) / (hi - lo) * 60) AS INTEGER) + 1, 60) AS bin, count(*) AS n FROM v, b GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, round(lo + (i - 1) * ((hi - lo) / 60), 6) AS low, round(lo + i * ((hi - lo) / 60), 6) AS high,
       coalesce(n, 0) AS count
FROM range(1, 61) t(i) CROSS JOIN b LEFT JOIN k ON k.bin = i""",
    ),
    "text_length_summary": (
        text_length_summary,
        f"SELECT 'text_length' AS \"column\", {_SUMMARY.format(c='length(text)')} FROM documents",
    ),
    "ttr_by_theme": (ttr_by_theme, _TTR),
    "ttr_top_p90": (ttr_top_p90, f"SELECT theme, p90 FROM ({_TTR}) ORDER BY tickets DESC, theme LIMIT 10"),
    "duration_gaps": (
        duration_gaps,
        f"""WITH {DURATIONS_SQL}
SELECT count(*) FILTER (open_hours >= 0) AS valid_rows,
       round(avg(CASE WHEN opened_at IS NULL THEN 1.0 ELSE 0.0 END), 6) AS opened_missing,
       round(avg(CASE WHEN closed_at IS NULL THEN 1.0 ELSE 0.0 END), 6) AS closed_missing FROM dur""",
    ),
    "repeat_contacts": (
        repeat_contacts,
        f"WITH {_REPEAT} SELECT event_id, round(hours, 6) AS hours_since_prev, coalesce(hours <= 168, false) AS is_repeat FROM h",
    ),
    "repeat_rate": (
        repeat_rate,
        f"WITH {_REPEAT} SELECT round(avg(CASE WHEN hours <= 24 THEN 1.0 ELSE 0.0 END), 6) AS repeat_rate FROM h",
    ),
    "repeat_by_theme": (
        repeat_by_theme,
        f"""WITH {_REPEAT},
t AS (SELECT theme, count(*) AS tickets, avg(CASE WHEN hours <= 24 THEN 1.0 ELSE 0.0 END) AS r FROM h GROUP BY 1)
SELECT theme, tickets, round(r, 6) AS repeat_rate FROM t ORDER BY r DESC, tickets DESC, theme""",
    ),
    "sample_exact": (
        sample_exact_500,
        "SELECT event_id, event_type, value FROM events ORDER BY md5(concat(event_id, '-42')), event_id LIMIT 500",
    ),
}
