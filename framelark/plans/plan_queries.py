"""Plans and smaller operators on the test tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framelark.functions import axis, text
from framelark.operators import lags, ordered, peaks, resample, runs, stretches
from framelark.plans import builders, checks, fit, media, spikes, steps, tracks, viewport
from framelark.plans.event_queries import _E, _ON, _SEQ, DAY, HOUR, MAPPING, events, of_type, query, sequence
from framelark.sources import recordings
from framelark.sources.tables import table
from framelark.streaming import rechunk

#: A recording for each user: its events are frames, some thousand seconds apart, and the axis has 200 frames.
SLOW = axis.Mapping(0.0001, 3, 120, 20, 0.0)
_SLOW = "(p + {head} + CASE WHEN p >= 120 THEN {gap} ELSE 0 END) / CAST(0.0001 AS DOUBLE) + 0"
_FRAMES = f"{_SEQ}, {_E}, f AS (SELECT s.user_id AS recording, s.p AS i, e.us / 1e6 AS pts, s.value AS mad, s.o FROM s JOIN e USING (event_id))"


def frames(spark, folder):
    rows = sequence(spark, folder)
    return rows.select(F.col("user_id").alias("recording"), F.col("p").alias("i"), (F.col("us") / 1e6).alias("pts"), F.col("value").alias("mad"), "o")


def spans_of_errors(spark, folder):
    return sequence(spark, folder).filter("o").select(F.col("user_id").alias("recording"), (F.col("p") * 2).alias("p"))


@query(f"""WITH {_FRAMES}, g AS (SELECT recording, max(pts) + coalesce(median(d), 0) / 2 AS stop FROM (SELECT recording, pts, lead(pts) OVER (PARTITION BY recording ORDER BY pts, i) - pts AS d FROM f) GROUP BY 1),
n AS (SELECT *, coalesce(lag(mad) OVER w, 0) AS a, coalesce(lead(mad) OVER w, 0) AS b FROM f WINDOW w AS (PARTITION BY recording ORDER BY i)),
r AS (SELECT *, mad < CAST(0.15 AS DOUBLE) * least(a, b) AND least(a, b) > 1.5 AS rep FROM n),
u AS (SELECT *, max(rep) OVER (PARTITION BY recording ORDER BY i ROWS BETWEEN 8 PRECEDING AND 8 FOLLOWING) AS burst FROM r),
t AS (SELECT p.range AS p, recording, stop, {_SLOW.format(head=3, gap=20).replace('p ', 'p.range ')} AS file_time FROM range(200) p, g),
m AS (SELECT t.recording, t.p, file_time, stop, arg_min((u.i, u.burst), (abs(u.pts - file_time), u.pts)) AS best FROM t JOIN u USING (recording) GROUP BY ALL)
SELECT recording, p, CAST(best[1] AS INTEGER) AS file_frame, file_time, CAST(CASE WHEN file_time > stop THEN 2 WHEN best[2] THEN 1 ELSE 0 END AS SMALLINT) AS flag FROM m""")
def q_frame_map(spark, folder):
    return fit.frame_map(SLOW, frames(spark, folder).drop("o"), 200)


@query(f"""WITH {_FRAMES}, h AS (SELECT recording, max(i) AS m, max(pts) AS stop FROM f GROUP BY 1), c AS (SELECT recording, i * 2 AS p FROM f WHERE o),
v AS (SELECT recording, p, variant, CASE WHEN p < 120 THEN 'A' ELSE 'B' END AS segment, stop, m,
(p + 3 + CASE variant WHEN 'head_minus_1' THEN -1 WHEN 'head_plus_1' THEN 1 ELSE 0 END + CASE WHEN p >= 120 AND variant <> 'no_gap' THEN 20 ELSE 0 END) / CAST(0.0001 AS DOUBLE) + 0 AS t
FROM c JOIN h USING (recording), (VALUES ('mapping'), ('head_minus_1'), ('head_plus_1'), ('no_gap')) AS x(variant)
WHERE (p + 3 + CASE WHEN p >= 120 THEN 20 ELSE 0 END) / CAST(0.0001 AS DOUBLE) + 0 < stop
UNION ALL SELECT f.recording, i * 3 + 1, 'mapping', 'titles', stop, m, (i * 3 + 1 + 3 + CASE WHEN i * 3 + 1 >= 120 THEN 20 ELSE 0 END) / CAST(0.0001 AS DOUBLE) + 0 FROM f JOIN h USING (recording) WHERE o),
n AS (SELECT v.recording, p, variant, segment, m, arg_min(f.i, (abs(pts - t), pts)) AS i FROM v JOIN f USING (recording) GROUP BY ALL),
w AS (SELECT n.*, w.range - 5 AS w FROM n, range(11) w),
b AS (SELECT w.recording, p, variant, segment, arg_min(w, (-mad, w)) AS o FROM w JOIN f ON f.recording = w.recording AND f.i = least(greatest(w.i + w, 0), m) GROUP BY ALL)
SELECT recording, variant, segment, count(*) AS n, avg(CAST(o = 0 AS INTEGER)) AS exact, avg(CAST(abs(o) <= 1 AS INTEGER)) AS within_1 FROM b GROUP BY 1, 2, 3""")
def q_check_cuts(spark, folder):
    """Frames that are drawn are left out here: SQL has another hash."""
    titles = spans_of_errors(spark, folder).select("recording", (F.col("p") / 2 * 3 + 1).cast("long").alias("p"))
    stats = checks.cut_stats(SLOW, frames(spark, folder).drop("o"), spans_of_errors(spark, folder), titles)
    return stats.filter("segment <> 'random'")


@query("""WITH s AS (SELECT event_type AS recording, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS p FROM events), e AS (SELECT recording, max(p) AS m FROM s GROUP BY 1),
v AS (SELECT * FROM (VALUES ('mapping', CAST(1 AS DOUBLE)), ('wrong_speed', CAST(1.04 AS DOUBLE))) AS v(variant, speed)), l AS (SELECT CAST(round(range * CAST(0.02 AS DOUBLE) - 1.5, 2) AS DOUBLE) AS lag FROM range(151)),
q AS (SELECT s.recording, variant, lag, value * value AS y, (((p + 0.5) * CAST(0.01 AS DOUBLE) + CAST(0.003 AS DOUBLE)) * speed + lag) / CAST(0.01 AS DOUBLE) - 0.5 AS place FROM s, v, l),
r AS (SELECT q.*, least(greatest(floor(place), 0), m) AS k FROM q JOIN e USING (recording))
SELECT r.recording, variant, lag, round(corr(a.value + least(greatest(place - r.k, 0), 1) * (coalesce(b.value, a.value) - a.value), y), 6) AS r
FROM r JOIN s a ON a.recording = r.recording AND a.p = r.k LEFT JOIN s b ON b.recording = r.recording AND b.p = r.k + 1 GROUP BY 1, 2, 3""")
def q_lag_scan(spark, folder):
    s = stretches.numbered(events(spark, folder).select(F.col("event_type").alias("recording"), "ts", "event_id", "value"), ["recording"], ["ts", "event_id"], "k")
    t = (F.col("k") + 0.5) * 0.01 + 0.003
    both = F.inline(F.array(*[F.struct(F.lit(name).alias("variant"), (t * speed).alias("t")) for name, speed in (("mapping", 1.0), ("wrong_speed", 1.04))]))
    points = s.select("recording", (F.col("value") * F.col("value")).alias("y"), both)
    found = lags.lag_correlation(points, s.select("recording", "k", F.col("value").alias("x")), ["recording"], "variant", checks.LAGS, 0.01, block=2.0)
    return found.withColumn("r", F.round("r", 6))


@query("""WITH s AS (SELECT event_type AS recording, value > 12 AS s, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS k FROM events),
a AS (SELECT recording, k, max(s) OVER (PARTITION BY recording ORDER BY k ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING) AS s FROM s),
b AS (SELECT recording, k, count(*) FILTER (WHERE s) OVER (PARTITION BY recording ORDER BY k ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING) = 15 AS s FROM a),
c AS (SELECT recording, k, count(*) FILTER (WHERE s) OVER (PARTITION BY recording ORDER BY k ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING) = 10 AS s FROM b),
d AS (SELECT recording, k, max(s) OVER (PARTITION BY recording ORDER BY k ROWS BETWEEN 4 PRECEDING AND 5 FOLLOWING) AS s FROM c),
x AS (SELECT *, lag(s, 1, false) OVER w AS before, lead(s, 1, false) OVER w AS after FROM d WINDOW w AS (PARTITION BY recording ORDER BY k)),
e AS (SELECT recording, 'first' AS side, k * CAST(0.01 AS DOUBLE) AS e FROM x WHERE s AND NOT before UNION ALL SELECT recording, 'last_excl', (k + 1) * CAST(0.01 AS DOUBLE) FROM x WHERE s AND NOT after),
p AS (SELECT event_id, event_type AS recording, 'first' AS side, event_id % 400 AS p FROM events UNION ALL SELECT event_id, event_type, 'last_excl', event_id % 400 + 2 + event_id % 7 FROM events),
t AS (SELECT event_id, recording, side, (p * CAST(0.04 AS DOUBLE) * 25 + 3 + CASE WHEN p * CAST(0.04 AS DOUBLE) * 25 >= 120 THEN 20 ELSE 0 END) / CAST(25 AS DOUBLE) + 0 AS t FROM p),
n AS (SELECT event_id, t.recording, side, arg_min(e - t, (abs(e - t), e)) AS shift FROM t JOIN e USING (recording, side) GROUP BY 1, 2, 3)
SELECT recording, side, round(median(shift), 9) AS shift FROM n WHERE abs(shift) < 1 GROUP BY 1, 2""")
def q_speech_shifts(spark, folder):
    """Ends of spans against ends of speech, where values above 12 are speech."""
    e = events(spark, folder).withColumnRenamed("event_type", "recording")
    vad = stretches.numbered(e.select("recording", "ts", "event_id", (F.col("value") > 12).cast("int").alias("v")), ["recording"], ["ts", "event_id"], "k")
    first = F.col("event_id") % 400
    spans = e.select("recording", first.alias("first"), (first + 2 + F.col("event_id") % 7).alias("last_excl"))
    found = checks.speech_shifts(axis.Mapping(25.0, 3, 120, 20, 0.0), vad.select("recording", "k", "v"), spans)
    return found.select("recording", "side", F.round("shift", 9).alias("shift"))


@query("SELECT doc_id, 'data:text/plain;base64,' || to_base64(encode(text)) AS uri FROM documents")
def q_data_uri(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.data_uri("text/plain", F.encode("text", "utf-8")).alias("uri"))


@query("""SELECT event_type AS label, CAST(i // 20 AS BIGINT) AS part, count(*) AS n, round(min(round(us / 1e6, 3)), 3) AS low, round(max(round(us / 1e6 + 2, 3)), 3) AS high
FROM (SELECT event_type, epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') AS us, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS i FROM events) GROUP BY 1, 2""")
def q_interval_parts(spark, folder):
    """A document of intervals for each kind of event, in parts of 20, each of which is read alone."""
    spans = events(spark, folder).select(F.col("event_type").alias("label"), F.col("event_id").alias("order"), (F.col("us") / 1e6).alias("a"), (F.col("us") / 1e6 + 2).alias("b"))
    parts = tracks.interval_parts(spans, 20)
    inside = F.concat(F.lit("["), F.regexp_replace(F.regexp_replace("text", r"^(\[|,)(?=\[)", ""), r"\]\]$", "]"), F.lit("]"))
    rows = parts.select("label", "part", F.explode(F.from_json(inside, "array<array<double>>")).alias("s"))
    return rows.groupBy("label", "part").agg(F.count(F.lit(1)).alias("n"), F.round(F.min(F.col("s")[0]), 3).alias("low"), F.round(F.max(F.col("s")[1]), 3).alias("high"))


@query(f"""WITH {_E}, h AS (SELECT k.user_id, CAST(round_even(k.us / 3.6e9 - x.us / 3.6e9, 0) AS BIGINT) AS f FROM e k JOIN e x USING (user_id) WHERE k.event_type = 'click' AND x.event_type = 'error'),
c AS (SELECT user_id, f, count(*) AS n FROM h WHERE f >= -30 AND f < 300 GROUP BY 1, 2),
a AS (SELECT user_id, arg_min(f, (-n, f)) AS f1, max(n) AS n1 FROM c GROUP BY 1),
b AS (SELECT user_id, arg_min(f, (-n, f)) AS f2, max(n) AS n2 FROM c JOIN a USING (user_id) WHERE f < f1 - 5 OR f >= f1 + 5 GROUP BY 1)
SELECT user_id, f1 AS "first", n1, coalesce(f2, 0) AS "second", coalesce(n2, 0) AS n2 FROM a LEFT JOIN b USING (user_id)""")
def q_fit_hist(spark, folder):
    in_hours = lambda kind: of_type(spark, folder, kind).select("user_id", (F.col("us") / HOUR).alias("h"))
    found = peaks.peaks_by(peaks.offsets(in_hours("click"), in_hours("error"), ["user_id"], "h", "h", -30, 300), ["user_id"], 2, 5)
    one, two = F.col("peaks")[0], F.col("peaks")[1]
    return found.select("user_id", one["offset"].alias("first"), one["n"].alias("n1"), two["offset"].alias("second"), two["n"].alias("n2"))


_SPIKES = f"""WITH {_E}, c AS (SELECT user_id, us, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) * CAST(0.04 AS DOUBLE) AS pts, event_id FROM e WHERE event_type = 'view'),
seg AS (SELECT user_id, us AS k0, pts AS v0, lead(us) OVER w AS k1, lead(pts) OVER w AS v1 FROM c WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
un AS (SELECT DISTINCT user_id AS patient, length(event_type) AS unit_id FROM e WHERE event_type <> 'view'),
t AS (SELECT k.user_id AS patient, length(k.event_type) AS unit_id, v0 + (k.us - k0) * (v1 - v0) / (k1 - k0) AS t FROM (SELECT * FROM e WHERE event_type <> 'view') k
ASOF JOIN (SELECT * FROM seg WHERE k1 IS NOT NULL) s ON k.user_id = s.user_id AND k.us >= s.k0 WHERE k.us <= k1 AND k1 - k0 <= 2e11 AND v1 <> v0)"""


def recorded(spark, folder):
    """Users as patients, kinds of events as units, their views as clocks."""
    e = events(spark, folder)
    order = F.row_number().over(Window.partitionBy("user_id").orderBy("us", "event_id"))
    clock = e.filter("event_type = 'view'").select(F.col("user_id").alias("patient"), F.col("event_id").alias("i"), axis.seconds(order).alias("pts"), F.col("us").cast("double").alias("neural_ms"))
    fired = e.filter("event_type <> 'view'").select(F.col("user_id").alias("patient"), F.length("event_type").cast("long").alias("unit_id"), F.col("us").cast("double").alias("t_ms"))
    return fired.select("patient", "unit_id").distinct(), fired, clock


@query(f"""{_SPIKES} SELECT un.patient, un.unit_id, count(t) AS n, coalesce(min(t), -1) AS low, coalesce(max(t), -1) AS high
FROM un LEFT JOIN t ON t.patient = un.patient AND t.unit_id = un.unit_id GROUP BY 1, 2""")
def q_spike_trains(spark, folder):
    units, fired, clock = recorded(spark, folder)
    trains = spikes.spike_trains(units, fired, clock, 2e11, 7 * DAY)
    ends = [F.coalesce(F.get("times", i), F.lit(-1.0)) for i in (F.lit(0), F.size("times") - 1)]
    return trains.select("patient", "unit_id", F.size("times").cast("long").alias("n"), ends[0].alias("low"), ends[1].alias("high"))


@query(f"""{_SPIKES}, k AS (SELECT patient, unit_id, count(*) AS count FROM t GROUP BY 1, 2), o AS (SELECT *, sum(count) OVER (PARTITION BY patient ORDER BY unit_id ROWS UNBOUNDED PRECEDING) - count AS below FROM k)
SELECT un.patient, un.unit_id, CAST(coalesce(below, 0) AS BIGINT) AS "offset", coalesce(count, 0) AS count FROM un LEFT JOIN o ON o.patient = un.patient AND o.unit_id = un.unit_id""")
def q_spike_track(spark, folder):
    units, fired, clock = recorded(spark, folder)
    none = F.lit("")
    named = units.select("patient", "unit_id", none.alias("region"), none.alias("hemisphere"), F.lit(True).alias("single_unit"), none.alias("cell_type"))
    track = tracks.spikes(named, spikes.spike_times(fired, clock, 2e11, 7 * DAY), "spikes", "Spikes")
    body = F.from_json("body", "patients array<struct<patient:long,units:array<struct<unit_id:long,offset:long,count:long>>>>")
    return track.select(F.inline(body["patients"])).select("patient", F.inline("units"))


@query(f"WITH {_ON}, i AS (SELECT user_id, p, p - row_number() OVER (PARTITION BY user_id ORDER BY p) AS g FROM s WHERE o), r AS (SELECT user_id, min(p) AS a, max(p) + 1 AS b FROM i GROUP BY user_id, g) SELECT CAST(user_id AS VARCHAR) AS label, round(a * CAST(0.04 AS DOUBLE), 3) AS a, round(b * CAST(0.04 AS DOUBLE), 3) AS b FROM r")
def q_annotation_track(spark, folder):
    marks = sequence(spark, folder).select(F.col("user_id").cast("string").alias("label"), "p", F.col("o").cast("short").alias("v"))
    body = builders.annotation_track(marks).select(F.from_json("body", "labels map<string, array<array<double>>>").alias("b"))
    return body.select(F.explode("b.labels").alias("label", "spans")).select("label", F.explode("spans").alias("s")).select("label", F.col("s")[0].alias("a"), F.col("s")[1].alias("b"))


@query("SELECT conv_id, round(turn * CAST(2.5 AS DOUBLE), 3) AS a, round(turn * CAST(2.5 AS DOUBLE) + 2, 3) AS b, text FROM conversations")
def q_text_track(spark, folder):
    """A document for each conversation, in parts of a few segments; each part is read alone."""
    rows = table(spark, folder, "conversations").select("conv_id", (F.col("turn") * 2.5).alias("a"), (F.col("turn") * 2.5 + 2).alias("b"), "text")
    parts = tracks.text_parts(rows, ["conv_id"], 3)
    inside = F.regexp_replace(F.regexp_replace("text", r'^(\{"segments":\[|,)', ""), r"\]\}$", "")
    return parts.select("conv_id", F.inline(F.from_json(F.concat(F.lit("["), inside, F.lit("]")), "array<struct<a:double,b:double,text:string>>")))


@query("SELECT event_id AS i, round(round(CAST(CAST(value AS FLOAT) AS DOUBLE), 5), 3) AS v FROM events")
def q_series_track(spark, folder):
    """One document of all events, in parts of some hundred values."""
    parts = tracks.series_parts(events(spark, folder).select(F.col("event_id").alias("i"), F.col("value").alias("v")), 0.0, 0.04, part=500)
    inside = F.regexp_replace(F.regexp_replace("text", r"^(.*\[|,)", ""), r"\]\}$", "")
    body = parts.select("part", F.posexplode(F.from_json(F.concat(F.lit("["), inside, F.lit("]")), "array<double>")).alias("at", "v"))
    return body.select((F.col("part") * 500 + F.col("at")).alias("i"), F.round("v", 3).alias("v"))


@query("""WITH p AS (SELECT l_linenumber AS stream, l_orderkey * 10000000 + l_partkey AS seq, l_shipdate AS dts, CAST(l_quantity AS BIGINT) AS size FROM lineitem)
SELECT stream, seq, row_number() OVER w - 1 AS place, CAST(sum(size) OVER w - size AS BIGINT) AS "offset" FROM p WINDOW w AS (ORDER BY dts, stream, seq ROWS UNBOUNDED PRECEDING)""")
def q_mux(spark, folder):
    rows = table(spark, folder, "lineitem").select(F.col("l_linenumber").alias("stream"), (F.col("l_orderkey") * 10_000_000 + F.col("l_partkey")).alias("seq"), F.col("l_shipdate").alias("dts"), F.col("l_quantity").cast("long").alias("size"))
    return media.mux_plan(rows).select("stream", "seq", "place", "offset")


@query(f"""{_SPIKES} SELECT patient, row_number() OVER (PARTITION BY patient ORDER BY unit_id, t) - 1 AS place, CAST(CAST(t AS FLOAT) AS DOUBLE) AS value FROM t""")
def q_spike_bytes(spark, folder):
    _, fired, clock = recorded(spark, folder)
    return ordered.read_numbers(tracks.spike_parts(spikes.spike_times(fired, clock, 2e11, 7 * DAY), 16), ["patient"])


@query("SELECT DISTINCT CAST(c_custkey % 40 AS INTEGER) AS patient FROM customer")
def q_sessions(spark, folder):
    path = F.concat(F.lit("raw/sub-"), (F.col("c_custkey") % 40).cast("string"), F.lit("/file.nwb"))
    return recordings.sessions(table(spark, folder, "customer").select(path.alias("path")))


@query("SELECT n_nationkey AS stream, n_name AS language FROM nation WHERE n_name = 'NATION_7'")
def q_chosen_stream(spark, folder):
    streams = table(spark, folder, "nation").select(F.col("n_nationkey").alias("stream"), F.col("n_name").alias("language"))
    return steps.chosen_stream(streams, "NATION_7")


@query("""WITH m AS (SELECT p_partkey AS recording, CASE p_size % 3 WHEN 0 THEN CAST(25 AS DOUBLE) WHEN 1 THEN CAST(24000 AS DOUBLE) / 1001 ELSE CAST(24 AS DOUBLE) END AS fps, p_size AS head, p_partkey * 97 % 140000 AS brk, p_size * 11 AS gap FROM part),
s AS (SELECT recording, fps, head, brk, gap, 0 AS segment, 0 AS p0, least(brk, 125743) AS p1 FROM m UNION ALL SELECT recording, fps, head, brk, gap, 1, least(brk, 125743), 125743 FROM m)
SELECT recording, segment, CAST(p0 * 1920 AS BIGINT) AS first_sample, CAST((p1 - p0) * 1920 AS BIGINT) AS n_samples, (p0 + head + CASE WHEN p0 >= brk THEN gap ELSE 0 END) / fps + 0 AS from_time, 25 / fps AS speed FROM s WHERE p1 > p0""")
def q_sound_plan(spark, folder):
    size = F.col("p_size").cast("long")
    fps = F.when(size % 3 == 0, 25.0).when(size % 3 == 1, 24000 / 1001).otherwise(24.0)
    m = table(spark, folder, "part").select(F.col("p_partkey").alias("recording"), fps.alias("film_fps"), size.alias("head"), (F.col("p_partkey") * 97 % 140_000).alias("brk"), (size * 11).alias("gap"), F.lit(0.0).alias("t0"))
    return media.sound_plans(m)


@query("""WITH s AS (SELECT event_type AS recording, value AS x, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS i FROM events),
c AS (SELECT recording, count(*) AS n FROM s GROUP BY 1), p AS (SELECT recording, 0 AS segment, 0 AS first_sample, n // 3 AS n_samples, CAST(5 AS DOUBLE) AS start FROM c UNION ALL SELECT recording, 1, n // 3, n // 2, CAST(n // 2 AS DOUBLE) FROM c),
o AS (SELECT recording, segment, first_sample + k.range AS sample, start, start + k.range * CAST(1.25 AS DOUBLE) AS place FROM p, range(100000) k WHERE k.range < n_samples),
t AS (SELECT o.*, floor(place) + w.range AS i, place - floor(place) - w.range AS d FROM o, range(-10, 11) w),
w AS (SELECT t.*, CASE WHEN abs(d) < 10 THEN 0.8 * CASE WHEN d = 0 THEN 1 ELSE sin(pi() * 0.8 * d) / (pi() * 0.8 * d) END * (0.42 + 0.5 * cos(pi() * abs(d) / 10) + 0.08 * cos(2 * pi() * abs(d) / 10)) ELSE 0 END AS weight FROM t)
SELECT w.recording, segment, sample, round(coalesce(sum(weight * x), 0), 6) AS y FROM w LEFT JOIN s ON s.recording = w.recording AND s.i = w.i AND w.i >= start GROUP BY 1, 2, 3""")
def q_resample(spark, folder):
    """Events' values by kind as sound, in chunks of 100, four fifths as fast, a third of them and, after a cut, a half."""
    s = stretches.numbered(events(spark, folder).select(F.col("event_type").alias("recording"), "ts", "event_id", "value"), ["recording"], ["ts", "event_id"], "i")
    chunks = s.groupBy("recording", (F.floor(F.col("i") / 100) * 100).alias("start")).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "value"))), lambda v: v["value"]).alias("x"))
    n = F.col("n")
    part = lambda k, first, size, start: F.struct(F.lit(k).alias("segment"), F.floor(first).alias("first_sample"), F.floor(size).alias("n_samples"), start.cast("double").alias("start"), F.lit(1.25).alias("step"))
    plan = s.groupBy("recording").agg(F.count(F.lit(1)).alias("n")).select("recording", F.inline(F.array(part(0, F.lit(0.0), n / 3, F.lit(5)), part(1, n / 3, n / 2, F.floor(n / 2)))))
    made = resample.resampled(chunks, plan, ["recording"], crossings=8, block=300, cell=256)
    rows = made.select("recording", "segment", "first_sample", F.posexplode("y").alias("at", "y"))
    return rows.select("recording", "segment", (F.col("first_sample") + F.col("at")).alias("sample"), F.round("y", 6).alias("y"))


@query("""WITH s AS (SELECT event_type AS k, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS i FROM events), n AS (SELECT k, max(i) AS m FROM s GROUP BY 1)
SELECT k, i // 64 AS number, count(*) AS n, arg_min(value, i) AS first, round(sum(value * (i % 64)), 4) AS weighted FROM s JOIN n USING (k) WHERE k <> 'view' OR (i // 64 + 1) * 64 <= m + 1 GROUP BY 1, 2""")
def q_rechunk(spark, folder):
    """Events' values by kind in chunks of 50, cut anew into chunks of 64; views haven't ended, so their rest isn't out."""
    s = stretches.numbered(events(spark, folder).select(F.col("event_type").alias("k"), "ts", "event_id", "value"), ["k"], ["ts", "event_id"], "i", "m")
    chunks = s.groupBy("k", F.floor(F.col("i") / 50).alias("seq")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "value"))), lambda v: v["value"]).alias("x"), ((F.max("i") + 1 == F.max("m")) & (F.col("k") != "view")).alias("last")
    )
    made = rechunk.rechunked_batch(chunks, ["k"], 64)
    weighted = F.aggregate(F.transform("x", lambda v, i: v * i), F.lit(0.0), lambda a, v: a + v)
    return made.select("k", "number", F.size("x").cast("long").alias("n"), F.col("x")[0].alias("first"), F.round(weighted, 4).alias("weighted"))


@query("""SELECT c_nationkey AS patient, c_custkey AS unit_id, CAST(row_number() OVER (ORDER BY c_mktsegment, c_nationkey, c_custkey) - 1 AS INTEGER) AS row FROM customer WHERE c_acctbal > 0 AND c_nationkey IN (3, 7, 11)""")
def q_unit_rows(spark, folder):
    units = table(spark, folder, "customer").select(F.col("c_nationkey").alias("patient"), F.col("c_mktsegment").alias("region"), F.col("c_custkey").alias("unit_id"), (F.col("c_acctbal") > 0).alias("single_unit"))
    return viewport.unit_rows(units, True, patients=[3, 7, 11], single_only=True).select("patient", "unit_id", "row")


@query("SELECT DISTINCT c_nationkey AS patient FROM customer ORDER BY 1 LIMIT 3")
def q_first_patients(spark, folder):
    return viewport.first_patients(table(spark, folder, "customer").select(F.col("c_nationkey").alias("patient")))


@query("SELECT event_id, CAST(CASE WHEN value / 0.5 <= 12 THEN 0.5 WHEN value / 2 <= 12 THEN 2 WHEN value / 5 <= 12 THEN 5 ELSE 600 END AS DOUBLE) AS step FROM (SELECT event_id, CAST(value AS DOUBLE) AS value FROM events)")
def q_tick_step(spark, folder):
    return events(spark, folder).select("event_id", text.tick_step(F.col("value"), [0.5, 2.0, 5.0]).alias("step"))


@query("SELECT event_id, (event_id % 500 / CAST(10 AS DOUBLE) * 25 + 25 + CASE WHEN event_id % 500 / CAST(10 AS DOUBLE) * 25 >= 97210 THEN 11020 ELSE 0 END) / (CAST(24000 AS DOUBLE) / 1001) + 0 AS source FROM events")
def q_to_source(spark, folder):
    return events(spark, folder).select("event_id", MAPPING.to_source(F.col("event_id") % 500 / F.lit(10.0)).alias("source"))


@query("SELECT event_id, event_id % 300 + event_id % 50 + CASE WHEN event_id % 300 >= 100 THEN 7 ELSE 0 END AS frame, (event_id % 300 + event_id % 50 + CASE WHEN event_id % 300 >= 100 THEN 7 ELSE 0 END) / CAST(25 AS DOUBLE) + 0.5 AS source FROM events")
def q_mapping_json(spark, folder):
    written = F.to_json(axis.Mapping(F.lit(25.0), F.col("event_id") % 50, F.lit(100), F.lit(7), F.lit(0.5)).struct())
    m = axis.mapping_from_json(F.col("m"))
    p = F.col("event_id") % 300
    return events(spark, folder).withColumn("m", written).select("event_id", m.source_frame(p).alias("frame"), m.source_time(p).alias("source"))


@query(f"""WITH {_SEQ}, a AS (SELECT user_id, p, o AS f FROM s WHERE p % 2 = 0 UNION ALL SELECT user_id, p, value > 50 FROM s WHERE p % 3 = 0)
SELECT user_id, p, bool_or(f) AS f, count(*) FILTER (WHERE f) AS n FROM a GROUP BY 1, 2""")
def q_either(spark, folder):
    s = sequence(spark, folder)
    return runs.either([s.filter("p % 2 = 0").withColumn("f", F.col("o")), s.filter("p % 3 = 0").withColumn("f", F.col("value") > 50)], ["user_id"], "p", "f")


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'new' ELSE event_type END AS kind, event_id % 2 AS parity, 5 AS own FROM events")
def q_merged_maps(spark, folder):
    old = F.create_map(F.lit("kind"), F.col("event_type"), F.lit("parity"), (F.col("event_id") % 2).cast("string"))
    new = F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("kind"), F.lit("new"), F.lit("own"), F.lit("5"))).otherwise(F.create_map(F.lit("own"), F.lit("5")))
    m = steps.merged_maps(old, new)
    return events(spark, folder).select("event_id", m["kind"].alias("kind"), m["parity"].cast("long").alias("parity"), m["own"].cast("int").alias("own"))


@query("SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 'screen' WHEN event_type = 'error' THEN 'fault' END AS \"group\" FROM events")
def q_label_groups(spark, folder):
    groups = {"screen": ["click", "view"], "fault": ["error", "view"]}
    return tracks.group_of(events(spark, folder).withColumnRenamed("event_type", "label"), groups).select("event_id", "group")


@query(f"""WITH {_E}, v AS (SELECT user_id, us, event_id, value, us + 3600000000 AS b FROM e)
SELECT 'spans' AS track, CAST(event_id AS VARCHAR) AS label, NULL AS bin, CAST(us AS DOUBLE) AS a, CAST(b AS DOUBLE) AS b, NULL AS low, NULL AS high, NULL AS n FROM v WHERE b >= 864000000000 AND us < 950400000000
UNION ALL SELECT CAST(user_id AS VARCHAR), NULL, CAST(floor((us - 864000000000) / 86400000000.0 * 24) AS BIGINT) AS bin, NULL, NULL, min(value), max(value), count(*) FROM v WHERE us >= 864000000000 AND us < 950400000000 GROUP BY user_id, bin
UNION ALL SELECT CAST(user_id AS VARCHAR), '1', CAST(floor((us - 864000000000) / 86400000000.0 * 24) AS BIGINT) AS bin, NULL, NULL, NULL, NULL, count(*) FROM v WHERE us >= 864000000000 AND us < 950400000000 GROUP BY user_id, bin""")
def q_window(spark, folder):
    e = events(spark, folder).withColumn("t", F.col("us").cast("double"))
    spans = e.select(F.lit("spans").alias("track"), F.col("event_id").cast("string").alias("label"), F.col("t").alias("a"), (F.col("t") + HOUR).alias("b"))
    samples, fired = e.select(F.col("user_id").cast("string").alias("track"), "t", F.col("value").alias("v")), e.select(F.col("user_id").alias("patient"), F.lit(1).alias("unit_id"), "t")
    return viewport.window(spans, samples, fired, 10 * DAY, 11 * DAY, 24)
