"""The operators on the test tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framelark.functions import axis, text
from framelark.operators import asof, peaks, runs, selection, signal, stabs, stretches
from framelark.plans import cues, media, steps, tracks, viewport
from framelark.sources import recordings, subtitles
from framelark.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

HOUR = 3_600_000_000.0
DAY = 24 * HOUR
#: Stretches of the time axis, in microseconds, that as-of joins are dealt by beside the user.
STRETCH = 7 * DAY
#: Rows of a stretch, few, so that the queries cross many borders.
ROWS = 10
MAPPING = axis.Mapping(24000 / 1001, 25, 97_210, 11_020)

_US = "epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')"
_E = f"e AS (SELECT *, {_US} AS us FROM events)"
_SEQ = "s AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS p, (event_type = 'error') AS o FROM events)"
_ON = f"{_SEQ}, on_ AS (SELECT user_id, p FROM (SELECT *, lag(o, 1, false) OVER (PARTITION BY user_id ORDER BY p) AS b FROM s) WHERE o AND NOT b)"


def query(sql: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return register


def events(spark: SparkSession, folder: str) -> DataFrame:
    us = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)")
    return table(spark, folder, "events").withColumn("us", us)


def sequence(spark: SparkSession, folder: str) -> DataFrame:
    """Events numbered by user; o: an error."""
    p = (F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1).cast("long")
    return events(spark, folder).withColumn("p", p).withColumn("o", F.col("event_type") == "error")


def of_type(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    return events(spark, folder).filter(F.col("event_type") == kind).select("user_id", "event_id", "us")


@query(f"WITH {_E} SELECT event_id, CAST(floor(us / 1e6 / (CAST(1 AS DOUBLE) / 25) + 1e-9) AS BIGINT) AS frame, floor(us / 1e6 / (CAST(1 AS DOUBLE) / 25) + 1e-9) * CAST(0.04 AS DOUBLE) AS seconds FROM e")
def q_frame_axis(spark, folder):
    frame = axis.frame_at(F.col("us") / 1e6)
    return events(spark, folder).select("event_id", frame.alias("frame"), axis.seconds(frame).alias("seconds"))


@query("SELECT event_id, printf('frame_%06d.jpg', event_id + 1) AS name, event_id AS back FROM events")
def q_frame_name(spark, folder):
    name = axis.name_of_frame(F.col("event_id"))
    return events(spark, folder).select("event_id", name.alias("name"), axis.frame_of_name(name).alias("back"))


@query(f"""WITH {_E}, m AS (SELECT event_id, CAST(round_even(us / 1e6 * 1000, 0) AS BIGINT) AS ms FROM e)
SELECT event_id, printf('%02d:%02d:%02d,%03d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000) AS code FROM m""")
def q_timecode(spark, folder):
    return events(spark, folder).select("event_id", text.time_code(F.col("us") / 1e6).alias("code"))


@query(f"WITH {_ON} SELECT user_id, p FROM on_")
def q_onsets(spark, folder):
    return runs.rising(sequence(spark, folder).select("user_id", "p", "o"), ["user_id"], "p", F.col("o"), ROWS).select("user_id", "p")


@query(f"WITH {_SEQ} SELECT user_id, p FROM (SELECT *, lead(o, 1, false) OVER (PARTITION BY user_id ORDER BY p) AS b FROM s) WHERE o AND NOT b")
def q_falling(spark, folder):
    return runs.falling(sequence(spark, folder).select("user_id", "p", "o"), ["user_id"], "p", F.col("o"), ROWS).select("user_id", "p")


@query(f"""WITH {_SEQ}, i AS (SELECT user_id, p, p - row_number() OVER (PARTITION BY user_id ORDER BY p) AS g FROM s WHERE o)
SELECT user_id, min(p) AS first, max(p) + 1 AS last_excl FROM i GROUP BY user_id, g""")
def q_runs(spark, folder):
    return runs.intervals(sequence(spark, folder).select("user_id", "p", "o"), ["user_id"], "p", F.col("o"), ROWS)


_CLOCK = """c AS (SELECT user_id, us, event_id, (row_number() OVER (PARTITION BY user_id ORDER BY us, event_id)) * CAST(0.04 AS DOUBLE) AS pts FROM e WHERE event_type = 'view'),
seg AS (SELECT user_id, us AS k0, pts AS v0, lead(us) OVER w AS k1, lead(pts) OVER w AS v1 FROM c WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id))"""
_INTERP = f"""WITH {_E}, {_CLOCK}
SELECT k.user_id, k.event_id, v0 + (k.us - k0) * (v1 - v0) / (k1 - k0) AS value
FROM (SELECT * FROM e WHERE event_type = 'click') k ASOF JOIN (SELECT * FROM seg WHERE k1 IS NOT NULL) s ON k.user_id = s.user_id AND k.us >= s.k0
WHERE k.us <= k1 AND k1 - k0 <= 2e11 AND v1 <> v0"""


def clicks_on_views(spark, folder):
    views = of_type(spark, folder, "view")
    order = F.row_number().over(Window.partitionBy("user_id").orderBy("us", "event_id"))
    clock = views.withColumn("pts", axis.seconds(order))
    return asof.interpolated(of_type(spark, folder, "click"), clock, ["user_id"], "us", "us", "pts", "event_id", 2e11, STRETCH)


@query(_INTERP)
def q_interp(spark, folder):
    return clicks_on_views(spark, folder).select("user_id", "event_id", "value")


@query(f"SELECT CAST(floor(value / CAST(0.2 AS DOUBLE)) AS BIGINT) AS bin, count(*) AS n FROM ({_INTERP}) GROUP BY 1")
def q_clicks_by_bin(spark, folder):
    return clicks_on_views(spark, folder).groupBy(F.floor(F.col("value") / 0.2).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


_NEAR = f"""WITH {_E} SELECT k.user_id, k.event_id, arg_min(x.us, (abs(x.us - k.us), x.us)) AS near_us
FROM e k JOIN e x ON k.user_id = x.user_id AND x.event_type = 'error' WHERE k.event_type = 'click' GROUP BY ALL"""


@query(_NEAR)
def q_nearest(spark, folder):
    found = asof.nearest(of_type(spark, folder, "click"), of_type(spark, folder, "error"), ["user_id"], "us", "us", "event_id", STRETCH)
    return found.filter("near IS NOT NULL").select("user_id", "event_id", F.col("near.us").alias("near_us"))


@query(f"SELECT n.user_id, n.event_id FROM ({_NEAR}) n JOIN events USING (event_id) WHERE abs(near_us - ({_US})) <= 3600000000")
def q_near_semi(spark, folder):
    clicks, errors = of_type(spark, folder, "click"), of_type(spark, folder, "error")
    return asof.within(clicks, errors, ["user_id"], "us", "us", "event_id", HOUR, STRETCH).select("user_id", "event_id")


@query(f"""SELECT n.user_id, median(near_us - ({_US})) AS shift FROM ({_NEAR}) n JOIN events e USING (event_id)
WHERE abs(near_us - ({_US})) < 86400000000 GROUP BY n.user_id""")
def q_edge_shift(spark, folder):
    found = asof.edge_shift(of_type(spark, folder, "click"), of_type(spark, folder, "error"), ["user_id"], "us", "us", "event_id", STRETCH)
    return found.filter(F.abs("shift") < DAY).groupBy("user_id").agg(F.median("shift").alias("shift"))


@query("SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 50)")
def q_anti(spark, folder):
    e = events(spark, folder)
    large = e.filter("event_type = 'error' AND value > 50").select("user_id")
    return e.select("user_id").distinct().join(large, "user_id", "left_anti")


_HIST = f"""WITH {_E}, d AS (SELECT CAST(round_even(k.us / 3.6e9 - x.us / 3.6e9, 0) AS BIGINT) AS "offset" FROM e k JOIN e x USING (user_id)
WHERE k.event_type = 'click' AND x.event_type = 'error') SELECT "offset", count(*) AS n FROM d WHERE "offset" >= -30 AND "offset" < 300 GROUP BY 1"""


def click_error_hours(spark, folder):
    in_hours = lambda kind: of_type(spark, folder, kind).select("user_id", (F.col("us") / HOUR).alias("h"))
    return peaks.offsets(in_hours("click"), in_hours("error"), ["user_id"], "h", "h", -30, 300).groupBy("offset").agg(F.sum("n").alias("n"))


@query(_HIST)
def q_offset_hist(spark, folder):
    return click_error_hours(spark, folder)


@query(f"""WITH RECURSIVE h AS ({_HIST}), turn AS (
SELECT 1 AS rank, (SELECT (n, -"offset") FROM h ORDER BY n DESC, "offset" LIMIT 1) AS best, [CAST(0 AS BIGINT)] AS gone
UNION ALL SELECT rank + 1, (SELECT (n, -"offset") FROM h WHERE NOT list_contains(gone2, "offset") ORDER BY n DESC, "offset" LIMIT 1), gone2 FROM
(SELECT rank, list_concat(CASE WHEN rank = 1 THEN [] ELSE gone END, range(-best[2] - 50, -best[2] + 50)) AS gone2 FROM turn WHERE rank < 4))
SELECT CAST(rank AS BIGINT) AS rank, -best[2] AS "offset", best[1] AS n FROM turn""")
def q_peaks4(spark, folder):
    found = peaks.peaks(click_error_hours(spark, folder), 4, 50)
    return spark.createDataFrame([(i + 1, o, n) for i, (o, n) in enumerate(found)], "rank long, offset long, n long")


@query("SELECT event_id, round_even(value / 2, 0) AS half FROM events")
def q_rint(spark, folder):
    return events(spark, folder).select("event_id", axis.half_even(F.col("value") / 2).alias("half"))


@query("""SELECT r.range AS bin, count(e.event_id) AS n FROM range(40) r LEFT JOIN events e ON CAST(floor(e.value / 5) AS BIGINT) = r.range GROUP BY 1""")
def q_dense_hist(spark, folder):
    counts = events(spark, folder).groupBy(F.floor(F.col("value") / 5).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return peaks.dense(counts, 0, 40, "bin")


_NB = "coalesce(lag(value) OVER w, 0) AS a, coalesce(lead(value) OVER w, 0) AS b"


@query(f"WITH {_SEQ} SELECT user_id, p FROM (SELECT *, {_NB} FROM s WINDOW w AS (PARTITION BY user_id ORDER BY p)) WHERE value > 8 AND value > 3 * greatest(a, b)")
def q_local_max(spark, folder):
    return signal.cuts(sequence(spark, folder).select("user_id", "p", "value"), ["user_id"], "p", "value", size=ROWS).select("user_id", "p")


@query("SELECT event_id, CAST(row_number() OVER (ORDER BY value, event_id) - 1 AS DOUBLE) / count(*) OVER () AS score FROM events")
def q_rank_all(spark, folder):
    return signal.rank01(events(spark, folder).select("event_id", "value"), [], "value", "event_id").select("event_id", "score")


@query("""SELECT event_id, CAST(row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) - 1 AS BIGINT) AS n, round(sum(value) OVER (PARTITION BY event_type ORDER BY value, event_id ROWS UNBOUNDED PRECEDING), 3) AS upto FROM events""")
def q_running(spark, folder):
    rows = stretches.numbered(events(spark, folder).select("event_id", "event_type", "value"), ["event_type"], ["value", "event_id"])
    return stretches.running(rows, ["event_type"], "n", "value", "upto", ROWS).select("event_id", "n", F.round("upto", 3).alias("upto"))


@query(f"WITH {_SEQ} SELECT event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY value, p) - 1 AS DOUBLE) / count(*) OVER (PARTITION BY user_id) AS score FROM s")
def q_rank01(spark, folder):
    return signal.rank01(sequence(spark, folder), ["user_id"], "value", "p").select("event_id", "score")


@query(f"WITH {_SEQ} SELECT event_id, max(o) OVER (PARTITION BY user_id ORDER BY p ROWS BETWEEN 8 PRECEDING AND 8 FOLLOWING) AS near_error FROM s")
def q_dilate(spark, folder):
    return runs.spread(sequence(spark, folder), ["user_id"], "p", "o", "near_error", 8, 8, ROWS).select("event_id", "near_error")


@query(f"""WITH {_SEQ}, n AS (SELECT *, value >= 20 AS f FROM s),
d AS (SELECT *, max(f) OVER (PARTITION BY user_id ORDER BY p ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS g FROM n),
c AS (SELECT *, count(*) FILTER (WHERE g) OVER (PARTITION BY user_id ORDER BY p ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) = 3 AS h FROM d),
x AS (SELECT *, count(*) FILTER (WHERE h) OVER (PARTITION BY user_id ORDER BY p ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) = 4 AS i FROM c)
SELECT event_id, max(i) OVER (PARTITION BY user_id ORDER BY p ROWS BETWEEN 1 PRECEDING AND 2 FOLLOWING) AS steady FROM x""")
def q_close_open(spark, folder):
    flagged = sequence(spark, folder).withColumn("f", F.col("value") >= 20)
    closed = runs.closed(flagged, ["user_id"], "p", "f", 3, ROWS)
    return runs.opened(closed, ["user_id"], "p", "f", 4, ROWS).select("event_id", F.col("f").alias("steady"))


@query(f"""WITH {_SEQ}, n AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS c FROM s),
i AS (SELECT event_id, user_id, c, unnest([p - 2, p - 1, p, p + 1, p + 2]) AS q FROM n)
SELECT i.event_id, round(sum(s.value) / 5, 6) AS smooth FROM i JOIN s ON s.user_id = i.user_id AND s.p = CASE WHEN q < 0 THEN -q - 1 WHEN q >= c THEN 2 * c - 1 - q ELSE q END GROUP BY 1""")
def q_box5(spark, folder):
    return runs.smoothed(sequence(spark, folder), ["user_id"], "p", "value", "smooth", ROWS).select("event_id", F.round("smooth", 6).alias("smooth"))


@query(f"WITH {_E} SELECT user_id, CAST(floor(us / 86400000000.0) AS BIGINT) AS bin, min(value) AS low, max(value) AS high, count(*) AS n FROM e WHERE us >= 0 AND us < 31536000000000 GROUP BY 1, 2")
def q_minmax_bin(spark, folder):
    return viewport.min_max(events(spark, folder), ["user_id"], "us", "value", 0.0, 365 * DAY, 365)


@query("""WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT event_type, least(0, min(value)) AS low, CASE WHEN max(value) FILTER (WHERE i = floor(CAST(0.995 AS DOUBLE) * (n - 1)) + 1) = 0 THEN 1 ELSE max(value) FILTER (WHERE i = floor(CAST(0.995 AS DOUBLE) * (n - 1)) + 1) END AS high FROM r GROUP BY 1""")
def q_q995(spark, folder):
    return signal.floor_percentile(events(spark, folder), ["event_type"], "value")


@query("""WITH h AS (SELECT user_id, CAST(floor(value / 10) AS BIGINT) AS bin, count(*) AS n FROM events GROUP BY 1, 2)
SELECT user_id, arg_min(bin, (-n, bin)) AS bin, max(n) AS n, arg_min(bin, (-n, -bin)) AS last_bin FROM h GROUP BY 1""")
def q_peak(spark, folder):
    bins = events(spark, folder).groupBy("user_id", F.floor(F.col("value") / 10).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    last = signal.best(bins, ["user_id"], "n", "bin", last=True).select("user_id", F.col("bin").alias("last_bin"))
    return signal.best(bins, ["user_id"], "n", "bin").join(last, "user_id")


@query("SELECT event_type, count(*) AS n, median(value) AS middle, min(value) AS low, max(value) AS high FROM events WHERE abs(value) < 30 GROUP BY 1")
def q_median(spark, folder):
    wanted = lambda n: {"a": F.floor((n - 1) / 2), "b": F.floor(n / 2), "low": F.lit(0), "high": n - 1}
    found = selection.selected(events(spark, folder).filter(F.abs("value") < 30), ["event_type"], "value", wanted)
    return found.select("event_type", "n", ((F.col("a") + F.col("b")) / 2).alias("middle"), "low", "high")


@query("SELECT median(l_extendedprice) AS median, count(*) AS n FROM lineitem")
def q_median_all(spark, folder):
    return selection.median(table(spark, folder, "lineitem"), [], "l_extendedprice")


@query(f"""WITH {_E}, sp AS (SELECT event_id AS span, us AS a, us + (event_id % 17) * 86400000000 * CASE WHEN event_id % 50 = 0 THEN 20 ELSE 0.01 END AS b FROM e WHERE event_type = 'error' AND value > 20)
SELECT k.event_id, count(*) AS n, min(span) AS first_span FROM e k JOIN sp ON a <= us AND us < b WHERE event_type = 'click' GROUP BY 1""")
def q_stab_long(spark, folder):
    """Spans of minutes and of most of the axis, of no entity."""
    errors = events(spark, folder).filter((F.col("event_type") == "error") & (F.col("value") > 20))
    length = F.col("event_id") % 17 * F.when(F.col("event_id") % 50 == 0, F.lit(DAY * 20)).otherwise(F.lit(DAY / 100))
    spans = errors.select(F.col("event_id").alias("span"), F.col("us").alias("a"), (F.col("us") + length).alias("b"))
    held = stabs.stab_counts(of_type(spark, folder, "click").select("event_id", "us"), spans, [], "us", "a", "b", "span", 1000)
    return held.groupBy("event_id").agg(F.sum("n").alias("n"), F.min("least").alias("first_span"))


_SPANS = "sp AS (SELECT user_id, us // 86400000000 AS day, min(us) AS a, max(us) AS b FROM e WHERE event_type = 'error' GROUP BY 1, 2)"


def error_spans(spark, folder):
    errors = of_type(spark, folder, "error").withColumn("day", F.floor(F.col("us") / DAY).cast("long"))
    return errors.groupBy("user_id", "day").agg(F.min("us").alias("a"), F.max("us").alias("b"))


@query(f"WITH {_E}, {_SPANS} SELECT e.event_id, sp.day FROM e JOIN sp ON e.user_id = sp.user_id AND a <= us AND us < b")
def q_stab(spark, folder):
    return runs.stabbed(events(spark, folder), error_spans(spark, folder), ["user_id"], "us", "a", "b", HOUR).select("event_id", "day")


@query(f"WITH {_SEQ}, x AS (SELECT user_id, value, lead(value) OVER (PARTITION BY user_id ORDER BY p) AS y FROM s) SELECT user_id, round(corr(value, y), 6) AS r FROM x WHERE y IS NOT NULL GROUP BY 1")
def q_lag_corr(spark, folder):
    ahead = F.lead("value").over(runs.over(["user_id"], "p"))
    pairs = sequence(spark, folder).withColumn("y", ahead).filter("y IS NOT NULL")
    return pairs.groupBy("user_id").agg(F.round(F.corr("value", "y"), 6).alias("r"))


@query(r"""SELECT doc_id, regexp_replace(regexp_replace(replace(regexp_replace(text, '^\x{FEFF}', ''), chr(13), ''), '</?[^>]+>', '', 'g'), '^\s+|\s+$', '', 'g') AS text FROM documents""")
def q_strip_tags(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.stripped(text.without_tags(text.without_mark(F.col("text")))).alias("text"))


@query("SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events")
def q_json(spark, folder):
    return events(spark, folder).select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("SELECT doc_id, substr(sha1(text), 1, 16) AS print, sha256(text) AS digest FROM documents")
def q_sha(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.short_sha1(F.col("text")).alias("print"), F.sha2("text", 256).alias("digest"))


@query("SELECT user_id, string_agg(t, ', ' ORDER BY t) AS labels FROM (SELECT DISTINCT user_id, event_type AS t FROM events) GROUP BY 1")
def q_join_labels(spark, folder):
    kinds = events(spark, folder).groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("t"))
    return kinds.select("user_id", F.array_join("t", ", ").alias("labels"))


@query(f"WITH {_E} SELECT user_id, count(*) AS n, count(*) / greatest(max(us / 1e6) - min(us / 1e6), 1) AS rate FROM e GROUP BY 1")
def q_unit_rate(spark, folder):
    return viewport.unit_rates(events(spark, folder).withColumn("t", F.col("us") / 1e6), ["user_id"], "t")


@query(f"""WITH {_E}, u AS (SELECT count(DISTINCT user_id) AS k FROM e), b AS (SELECT CAST(floor(us / 1e6 / 2592000 * 100) AS BIGINT) AS bin, count(*) AS n FROM e WHERE us >= 0 AND us / 1e6 < 2592000 GROUP BY 1)
SELECT r.range AS bin, coalesce(n, 0) / CAST(25920 AS DOUBLE) / k AS rate FROM range(100) r LEFT JOIN b ON b.bin = r.range, u""")
def q_pop_rate(spark, folder):
    e = events(spark, folder).withColumn("t", F.col("us") / 1e6)
    return viewport.population_rate(e, "t", 0.0, 2_592_000.0, 100, e.select("user_id").distinct().count())


@query(f"""WITH {_E}, r AS (SELECT user_id, count(*) / greatest(max(us / 1e6) - min(us / 1e6), 1) AS rate FROM e GROUP BY 1),
b AS (SELECT user_id, CAST(floor(us / 1e6 / 2592000 * 100) AS BIGINT) AS bin, count(*) AS n FROM e WHERE us >= 0 AND us / 1e6 < 2592000 GROUP BY 1, 2)
SELECT user_id, bin, n, least(greatest(n / (4 * (rate * 25920) + 1e-9), 0.08), 1) AS intensity FROM b JOIN r USING (user_id)""")
def q_heat(spark, folder):
    return viewport.heat(events(spark, folder).withColumn("t", F.col("us") / 1e6), ["user_id"], "t", 0.0, 2_592_000.0, 100)


@query(f"""WITH {_SEQ}, c AS (SELECT *, p - row_number() OVER (PARTITION BY user_id, event_type ORDER BY p) AS g FROM s)
SELECT user_id, event_type, min(p) AS first, max(p) AS last, count(*) AS n FROM c GROUP BY user_id, event_type, g""")
def q_bands(spark, folder):
    return runs.bands(events(spark, folder).select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"], "event_type", ROWS)


@query("""WITH c AS (SELECT user_id AS patient, event_type, count(*) AS count FROM events GROUP BY 1, 2), u AS (SELECT *, dense_rank() OVER (ORDER BY event_type) AS unit_id FROM c)
SELECT patient, unit_id, count, CAST(sum(count) OVER (PARTITION BY patient ORDER BY unit_id ROWS UNBOUNDED PRECEDING) - count AS BIGINT) AS "offset" FROM u""")
def q_offsets_sink(spark, folder):
    e = events(spark, folder)
    units = e.select("event_type").distinct().withColumn("unit_id", F.dense_rank().over(Window.partitionBy(F.lit(0)).orderBy("event_type")).cast("long"))
    return tracks.spike_offsets(e.join(units, "event_type").select(F.col("user_id").alias("patient"), "unit_id", F.col("us").alias("t")))


_P = "event_id * 997 % 125743"
_SRC = f"(p + 25 + CASE WHEN p >= 97210 THEN 11020 ELSE 0 END) / (CAST(24000 AS DOUBLE) / 1001) + 0"


@query(f"WITH m AS (SELECT event_id, {_P} AS p FROM events) SELECT event_id, p + 25 + CASE WHEN p >= 97210 THEN 11020 ELSE 0 END AS source_frame, {_SRC} AS source_time FROM m")
def q_map_fwd(spark, folder):
    p = F.col("event_id") * 997 % 125_743
    return events(spark, folder).select("event_id", MAPPING.source_frame(p).alias("source_frame"), MAPPING.source_time(p).alias("source_time"))


@query("""WITH m AS (SELECT event_id, event_id * 997 % 150000 / CAST(25 AS DOUBLE) AS t FROM events), f AS (SELECT *, t * (CAST(24000 AS DOUBLE) / 1001) - 25 AS a FROM m),
p AS (SELECT *, CASE WHEN a < 97210 THEN a WHEN a - 11020 >= 97210 THEN a - 11020 END AS p FROM f)
SELECT event_id, CASE WHEN p >= 0 AND p <= 125743 THEN p / 25 END AS axis_time FROM p""")
def q_map_inv(spark, folder):
    t = F.col("event_id") * 997 % 150_000 / F.lit(25.0)
    return events(spark, folder).select("event_id", MAPPING.to_axis(t).alias("axis_time"))


@query(f"""WITH {_SEQ}, n AS (SELECT *, {_NB} FROM s WINDOW w AS (PARTITION BY user_id ORDER BY p)),
r AS (SELECT *, value < CAST(0.15 AS DOUBLE) * least(a, b) AND least(a, b) > 1.5 AS rep FROM n),
u AS (SELECT *, max(rep) OVER (PARTITION BY user_id ORDER BY p ROWS BETWEEN 8 PRECEDING AND 8 FOLLOWING) AS burst FROM r)
SELECT event_id, CAST(CASE WHEN p > 70 THEN 2 WHEN burst THEN 1 ELSE 0 END AS SMALLINT) AS flag FROM u""")
def q_frame_flags(spark, folder):
    marked = signal.near_repeats(sequence(spark, folder), ["user_id"], "p", "value", size=ROWS)
    return marked.select("event_id", F.when(F.col("p") > 70, 2).when(F.col("burst"), 1).otherwise(0).cast("smallint").alias("flag"))


_AROUND = f"""{_ON}, n AS (SELECT user_id, max(p) AS m FROM s GROUP BY 1), x AS (SELECT o.user_id, o.p, m, unnest(range(-5, 6)) AS w FROM on_ o JOIN n USING (user_id)),
y AS (SELECT x.user_id, x.p, w, value FROM x JOIN s ON s.user_id = x.user_id AND s.p = least(greatest(x.p + w, 0), m))"""


@query(f'WITH {_AROUND} SELECT user_id, p, CAST(arg_min(w, (-value, w)) AS INTEGER) AS "offset" FROM y GROUP BY 1, 2')
def q_cut_offsets(spark, folder):
    s = sequence(spark, folder).select("user_id", "p", "o", "value")
    at = runs.rising(s, ["user_id"], "p", F.col("o")).select("user_id", "p")
    return signal.loudest_nearby(s, at, ["user_id"], "p", "value", 5)


@query(f"""WITH {_SEQ}, v AS (SELECT unnest([-1, 0, 1]) AS variant), h AS (SELECT variant, CASE WHEN a.p < 30 THEN 'A' ELSE 'B' END AS segment, b.value > 50 AS hit
FROM s a JOIN v ON true JOIN s b ON b.user_id = a.user_id AND b.p = a.p + variant WHERE a.o)
SELECT variant, segment, count(*) AS n, avg(CAST(hit AS DOUBLE)) AS exact, bool_and(hit) AS every FROM h GROUP BY 1, 2""")
def q_controls(spark, folder):
    s = sequence(spark, folder).select("user_id", "p", "o", "value")
    variants = spark.createDataFrame([(-1,), (0,), (1,)], "variant int")
    at = s.filter("o").select("user_id", "p").crossJoin(F.broadcast(variants)).withColumn("segment", F.when(F.col("p") < 30, "A").otherwise("B"))
    hits = at.withColumn("p", F.col("p") + F.col("variant")).join(s.select("user_id", "p", "value"), ["user_id", "p"]).withColumn("hit", F.col("value") > 50)
    return hits.groupBy("variant", "segment").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("hit").cast("double")).alias("exact"), F.bool_and("hit").alias("every"))


@query("""WITH v AS (SELECT vec_id, label, embedding AS e, lag(embedding) OVER (PARTITION BY label ORDER BY vec_id) AS b FROM embeddings)
SELECT vec_id, CAST(round(coalesce(list_sum([abs(CAST(e[i] AS DOUBLE) - CAST(b[i] AS DOUBLE)) for i in range(1, len(e) + 1)]) / len(e), 0), 4) AS DOUBLE) AS mad FROM v""")
def q_mad_vec(spark, folder):
    frames = stretches.numbered(table(spark, folder, "embeddings"), ["label"], "vec_id", "i")
    moved = signal.frame_signal(frames, ["label"], "i", "embedding", ROWS)
    return moved.select("vec_id", F.round(F.col("mad").cast("double"), 4).alias("mad"))


@query(f"WITH {_ON} SELECT user_id, p FROM on_ UNION SELECT user_id, p FROM s WHERE value > 60")
def q_union_distinct(spark, folder):
    s = sequence(spark, folder)
    return runs.rising(s.select("user_id", "p", "o"), ["user_id"], "p", F.col("o")).select("user_id", "p").unionByName(s.filter("value > 60").select("user_id", "p")).distinct()


_CUES = """cu AS (SELECT conv_id, turn, CAST(conv_id * 7 % 5600 + turn * 3 AS DOUBLE) AS a, CAST(conv_id * 7 % 5600 + turn * 3 + 2 AS DOUBLE) AS b, text FROM conversations WHERE length(trim(text)) > 0),
f AS (SELECT *, a * (CAST(24000 AS DOUBLE) / 1001) - 25 AS fa, b * (CAST(24000 AS DOUBLE) / 1001) - 25 AS fb FROM cu),
g AS (SELECT *, CASE WHEN fa < 97210 THEN fa WHEN fa - 11020 >= 97210 THEN fa - 11020 END AS pa, CASE WHEN fb < 97210 THEN fb WHEN fb - 11020 >= 97210 THEN fb - 11020 END AS pb FROM f),
h AS (SELECT *, CASE WHEN pa >= 0 AND pa <= 125743 THEN pa / 25 END AS ta, CASE WHEN pb >= 0 AND pb <= 125743 THEN pb / 25 END AS tb FROM g)"""


@query(f"""WITH {_CUES} SELECT conv_id, turn, ta AS "start", CASE WHEN tb IS NULL OR (ta < 97210 * CAST(0.04 AS DOUBLE) AND 97210 * CAST(0.04 AS DOUBLE) <= tb) THEN
CASE WHEN ta < 97210 * CAST(0.04 AS DOUBLE) THEN least(97210 * CAST(0.04 AS DOUBLE), CAST(5029.72 AS DOUBLE)) ELSE CAST(5029.72 AS DOUBLE) END ELSE tb END AS "end" FROM h WHERE ta IS NOT NULL""")
def q_cues(spark, folder):
    rows = table(spark, folder, "conversations").filter(F.length(F.trim("text")) > 0)
    start = (F.col("conv_id") * 7 % 5600 + F.col("turn") * 3).cast("double")
    return cues.retimed(rows.withColumn("start", start).withColumn("end", start + 2), MAPPING).select("conv_id", "turn", "start", "end")


@query("""SELECT event_id % 100 AS step, CASE WHEN min(event_type) = 'click' OR max(value) < 60 THEN 'missing' WHEN min(event_type) = max(event_type) THEN 'ok' ELSE 'stale' END AS state FROM events GROUP BY 1""")
def q_stage_state(spark, folder):
    rows = events(spark, folder).groupBy((F.col("event_id") % 100).alias("step")).agg(F.min("event_type").alias("low"), F.max("event_type").alias("signature"), (F.max("value") >= 60).alias("present"))
    return steps.states(rows.withColumn("stamp", F.when(F.col("low") != "click", F.col("low"))))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT o_orderkey, o_custkey, 0.0 FROM orders WHERE o_orderstatus = 'F'")
def q_upsert(spark, folder):
    orders = table(spark, folder, "orders")
    old = orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return steps.upserted(old, orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", F.lit(0.0).alias("o_totalprice")), "o_orderkey")


@query("SELECT p_partkey AS path, CAST(p_size AS BIGINT) AS size, sha256(p_name) AS sha256 FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)")
def q_to_fetch(spark, folder):
    wanted = table(spark, folder, "part").select(F.col("p_partkey").alias("path"), F.col("p_size").cast("long").alias("size"), F.sha2("p_name", 256).alias("sha256"))
    there = table(spark, folder, "lineitem").filter("l_quantity > 49").select(F.col("l_partkey").alias("path")).distinct()
    return steps.to_fetch(wanted, wanted.join(there, "path", "left_semi"))


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_shipdate, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber) - 1 AS p FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN p % 7 = 6 THEN 'black' WHEN p // 2 = (p - 1) // 2 AND p > 0 THEN 'repeat' ELSE 'show' END AS action FROM l""")
def q_picture_plan(spark, folder):
    w = Window.partitionBy("l_orderkey").orderBy("l_shipdate", "l_linenumber")
    p = (F.row_number().over(w) - 1).cast("long")
    rows = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("recording"), "l_linenumber", p.alias("p"))
    plan = media.picture_plan(rows.select("recording", F.struct("p", "l_linenumber", "recording").alias("p"), F.floor(F.col("p") / 2).alias("file_frame"), F.when(F.col("p") % 7 == 6, 2).otherwise(0).alias("flag")))
    return plan.select(F.col("p.recording").alias("l_orderkey"), F.col("p.l_linenumber").alias("l_linenumber"), "action")


@query("SELECT vec_id, x, CAST(CAST(trunc(least(greatest(CAST(x AS DOUBLE), -1), 1) * 32767) AS INTEGER) AS SMALLINT) AS pcm FROM (SELECT vec_id, embedding[1] AS x FROM embeddings)")
def q_pcm(spark, folder):
    return table(spark, folder, "embeddings").select("vec_id", F.element_at("embedding", 1).alias("x")).withColumn("pcm", text.pcm16(F.col("x")))


@query("SELECT i AS n, round(avg(CAST(e AS DOUBLE)), 6) AS x FROM (SELECT unnest(embedding) AS e, unnest(range(len(embedding))) AS i FROM embeddings) GROUP BY 1")
def q_mono(spark, folder):
    rows = table(spark, folder, "embeddings").select(F.col("vec_id").alias("channel"), F.posexplode("embedding").alias("n", "x"))
    return media.mono(rows.select("channel", F.col("n").cast("long").alias("n"), F.col("x").cast("double").alias("x"))).select("n", F.round("x", 6).alias("x"))


@query("SELECT user_id, event_id, us AS value_us FROM (SELECT *, epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') AS us FROM events) WHERE us >= 86400000000 AND us < 864000000000")
def q_visible(spark, folder):
    e = events(spark, folder)
    return viewport.visible(e.withColumn("b", F.col("us")), "us", "b", DAY, 10 * DAY).select("user_id", "event_id", F.col("us").alias("value_us"))


@query("""WITH g AS (SELECT event_id AS k, value AS x FROM events), p AS (SELECT event_id, event_id * CAST(0.013 AS DOUBLE) - 3 AS t FROM events),
c AS (SELECT *, t / CAST(0.01 AS DOUBLE) - 0.5 AS place, CAST(least(greatest(floor(t / CAST(0.01 AS DOUBLE) - 0.5), 0), (SELECT max(k) FROM g)) AS BIGINT) AS k FROM p)
SELECT c.event_id, round(a.x + least(greatest(place - c.k, 0), 1) * (coalesce(b.x, a.x) - a.x), 6) AS x FROM c JOIN g a ON a.k = c.k LEFT JOIN g b ON b.k = c.k + 1""")
def q_grid_value(spark, folder):
    e = events(spark, folder)
    points = e.select("event_id", (F.col("event_id") * 0.013 - 3).alias("t"))
    grid = e.select(F.col("event_id").alias("k"), F.col("value").alias("x"))
    return asof.grid_value(points, grid, F.col("t"), 0.01).select("event_id", F.round("x", 6).alias("x"))


_LINES = """t AS (SELECT conv_id, turn, turn * CAST(2.5 AS DOUBLE) AS a, turn * CAST(2.5 AS DOUBLE) + 2 AS b, regexp_replace(text, '[\\s<>]+', ' ', 'g') AS text
FROM conversations WHERE length(trim(regexp_replace(text, '[\\s<>]+', ' ', 'g'))) > 0)"""


def spoken_lines(spark, folder):
    clean = F.regexp_replace("text", r"[\s<>]+", " ")
    rows = table(spark, folder, "conversations").select("conv_id", "turn", (F.col("turn") * 2.5).alias("start"), (F.col("turn") * 2.5 + 2).alias("end"), clean.alias("text"))
    return rows.filter(F.length(F.trim("text")) > 0)


def _code(ms: str, mark: str) -> str:
    return f"printf('00:%02d:%02d{mark}%03d', {ms} // 60000, {ms} // 1000 % 60, {ms} % 1000)"


@query(f"""WITH {_LINES}, n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, CAST(a * 1000 AS BIGINT) AS x, CAST(b * 1000 AS BIGINT) AS y FROM t)
SELECT conv_id, string_agg(i || chr(10) || {_code('x', ',')} || ' --> ' || {_code('y', ',')} || chr(10) || text || chr(10), chr(10) ORDER BY i) AS srt,
'WEBVTT' || chr(10) || chr(10) || string_agg({_code('x', '.')} || ' --> ' || {_code('y', '.')} || chr(10) || text || chr(10), chr(10) ORDER BY i) AS vtt FROM n GROUP BY 1""")
def q_cue_files(spark, folder):
    return cues.as_text(spoken_lines(spark, folder), ["conv_id"], "turn").select("conv_id", "srt", "vtt")


@query(f"WITH {_LINES} SELECT conv_id, a AS start, b AS \"end\", trim(text) AS text FROM t")
def q_parse_srt(spark, folder):
    files = cues.as_text(spoken_lines(spark, folder), ["conv_id"], "turn")
    return files.select("conv_id", F.inline(subtitles.parsed(F.col("srt"))))


@query("SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'click') AS clicks FROM events GROUP BY 1")
def q_unit_counts(spark, folder):
    return events(spark, folder).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "click").alias("clicks"))


@query("""SELECT doc_id, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS text FROM documents""")
def q_html_escape(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.html_escaped(F.col("text")).alias("text"))


@query("""WITH h AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN event_id % 70 WHEN 1 THEN event_id % 120 END AS a, CASE event_id % 3 WHEN 0 THEN event_id % 70 + event_id % 50 WHEN 2 THEN event_id % 130 END AS b FROM events),
r AS (SELECT event_id, coalesce(a, greatest(100 - b, 0)) AS f, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN least(b, 99) ELSE 99 END AS l FROM h)
SELECT event_id, CASE WHEN f <= l AND f < 100 THEN f ELSE -1 END AS first, CASE WHEN f <= l AND f < 100 THEN l ELSE -1 END AS last FROM r""")
def q_byte_range(spark, folder):
    e = F.col("event_id")
    a = F.when(e % 3 == 0, (e % 70).cast("string")).when(e % 3 == 1, (e % 120).cast("string")).otherwise("")
    b = F.when(e % 3 == 0, (e % 70 + e % 50).cast("string")).when(e % 3 == 2, (e % 130).cast("string")).otherwise("")
    found = text.byte_range(F.concat(F.lit("bytes="), a, F.lit("-"), b), F.lit(100).cast("long"))
    return events(spark, folder).select("event_id", found.alias("r")).select("event_id", F.coalesce("r.first", F.lit(-1)).alias("first"), F.coalesce("r.last", F.lit(-1)).alias("last"))


@query(f"WITH {_E} SELECT event_id, printf('%02d:%02d.%02d', us // 60000000, us % 60000000 // 1000000, us % 1000000 // 10000) AS shown FROM e")
def q_clock(spark, folder):
    return events(spark, folder).select("event_id", text.clock(F.floor(F.col("us") / 10_000) / 100).alias("shown"))


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2), k AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY event_type) AS upto FROM c),
d AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos FROM events)
SELECT d.user_id, d.event_id, k.event_type AS unit FROM d JOIN k ON d.user_id = k.user_id AND d.pos >= k.upto - k.n AND d.pos < k.upto""")
def q_ragged(spark, folder):
    e = events(spark, folder)
    w = Window.partitionBy("user_id").orderBy("event_type")
    counts = e.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    ends = counts.select("user_id", "event_type", F.row_number().over(w).cast("long").alias("unit"), F.sum("n").over(w).alias("end"))
    pos = (F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1).cast("long")
    data = e.select("user_id", pos.alias("pos"), F.col("event_id").alias("value"))
    found = recordings.ragged(data, ends.select("user_id", "unit", "end"), ["user_id"])
    return found.join(ends.select("user_id", "unit", "event_type"), ["user_id", "unit"]).select("user_id", F.col("value").alias("event_id"), F.col("event_type").alias("unit"))


@query("SELECT c_custkey, c_nationkey, n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON n_nationkey = c_nationkey")
def q_known_copies(spark, folder):
    files = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("fingerprint"))
    registry = table(spark, folder, "nation").filter("n_regionkey < 3").select(F.col("n_nationkey").alias("fingerprint"), "n_name")
    return steps.known_copies(files, registry).select("c_custkey", F.col("fingerprint").alias("c_nationkey"), "n_name")


@query("SELECT count(*) AS files, CAST(sum(p_size) AS BIGINT) AS bytes FROM part")
def q_fetch_total(spark, folder):
    return steps.fetch_total(table(spark, folder, "part").select(F.col("p_size").cast("long").alias("size")))


@query(f"""WITH {_E}, x AS (SELECT user_id, event_id, us, event_type, row_number() OVER (PARTITION BY user_id ORDER BY us + 3600000000, us) AS rn FROM e WHERE us + 3600000000 >= 864000000000 + 0.000000001 AND us <= 864000000000)
SELECT user_id, event_id FROM x WHERE rn = 1""")
def q_current(spark, folder):
    spans = events(spark, folder).select("user_id", F.col("us").alias("a"), (F.col("us") + 3_600_000_000).alias("b"), "event_id")
    return viewport.current(spans, ["user_id"], "a", "b", 10 * DAY).select("user_id", "event_id")
