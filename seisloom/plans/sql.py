"""SQL of queries whose operators take their rows one after another: greedy passes, anchors, recursive filters, components.

DuckDB's ``list_reduce`` walks an ordered list with what it has accepted so far, so these say what the operators
mean without their blocks, rounds and joins.
"""

from __future__ import annotations

from ..functions.geo import LAYERS
from ..operators.arrays import butterworth


def walk(fields: str, order: str, refused: str) -> str:
    """The list of structs ``fields`` accepted in ``order``: each unless ``refused`` holds for some ``y`` of those before and it (``x[1]``)."""
    return (
        f"list_reduce(list([{fields}] ORDER BY {order}), lambda acc, x: CASE WHEN len(list_filter(acc, lambda y: {refused})) > 0 "
        "THEN acc ELSE list_concat(acc, x) END)"
    )


def anchors(times: str, width: int) -> str:
    """``anchor``: the times of table ``times(t_us)`` that begin a cluster."""
    return (
        f"SELECT unnest(list_reduce(list([t_us] ORDER BY t_us), lambda acc, x: CASE WHEN x[1] - acc[len(acc)] > {width} "
        f"THEN list_concat(acc, x) ELSE acc END)) AS anchor FROM (SELECT DISTINCT t_us FROM {times})"
    )


def sections(x: str, kind: str, hz: float, rate: float, order: int = 4) -> str:
    """List ``x`` through the second-order sections of a filter, sample after sample."""
    for b0, b1, b2, a1, a2 in butterworth(order, hz, rate, kind).tolist():
        y = f"({b0!r}::DOUBLE * x[1] + acc[1])"
        step = f"[{b1!r}::DOUBLE * x[1] - {a1!r}::DOUBLE * {y} + acc[2], {b2!r}::DOUBLE * x[1] - {a2!r}::DOUBLE * {y}]"
        x = f"list_reduce(list_prepend([0::DOUBLE, 0::DOUBLE], list_transform({x}, lambda u: [u])), lambda acc, x: list_concat({step}, acc[3:], [{y}]))[3:]"
    return x


def both_ways(x: str, kind: str, hz: float, rate: float) -> str:
    return f"list_reverse({sections(f'list_reverse({sections(x, kind, hz, rate)})', kind, hz, rate)})"


def struct(*names: str) -> str:
    return "{" + ", ".join(f"'{n}': {n}" for n in names) + "}"


PEAKS = "SELECT series, idx, value FROM (SELECT *, lag(value) OVER w AS b, lead(value) OVER w AS a FROM v_series WINDOW w AS (PARTITION BY series ORDER BY idx)) WHERE value > b AND value >= a AND value >= 30000"
WN05 = f"SELECT series, k.idx AS idx, k.value AS value FROM (SELECT series, unnest({walk(struct('idx', 'value'), 'value DESC, idx', 'abs(y.idx - x[1].idx) <= 5')}) AS k FROM ({PEAKS}) GROUP BY series)"
WN07 = f"SELECT k.pick_id AS pick_id, station, phase, k.t_us AS t_us, k.probability AS probability FROM (SELECT station, phase, unnest({walk(struct('pick_id', 't_us', 'probability'), 'probability DESC, t_us', 'abs(y.t_us - x[1].t_us) <= 3600000000')}) AS k FROM v_picks GROUP BY station, phase)"
WN16 = f"SELECT k.det_id AS det_id, template_id, k.t_us AS t_us, k.correlation AS correlation FROM (SELECT template_id, unnest({walk(struct('det_id', 't_us', 'correlation'), 'correlation DESC, t_us', 'abs(y.t_us - x[1].t_us) <= 3600000000')}) AS k FROM v_detections GROUP BY template_id)"
WN19 = f"""SELECT station, phase, k.file AS file, k.start_us AS start_us, k.end_us AS end_us FROM (SELECT station, phase, unnest({walk(struct('file', 'start_us', 'end_us'), 'file, start_us, end_us', 'abs(y.start_us - x[1].start_us) < 1000000 AND abs(y.end_us - x[1].end_us) < 1000000')}) AS k FROM (
SELECT station, phase, start_us, start_us + 600000000 AS end_us, min(pick_id) AS file FROM (SELECT *, t_us // 600000000 * 600000000 + k * 10000 AS start_us FROM v_picks) GROUP BY ALL) GROUP BY station, phase)"""
WN11 = f"SELECT anchor, count(*) AS n, max(t_us) AS last_us FROM v_detections d ASOF JOIN ({anchors('v_detections', 600_000_000)}) a ON d.t_us >= a.anchor GROUP BY anchor"

#: Strong detections, their anchors, clusters, and clusters far enough from confirmed events.
CANDIDATES = f""", strong AS (SELECT det_id, t_us, template_id, abs(correlation) / n_chans AS per_chan FROM v_detections WHERE abs(correlation) / n_chans >= 0.5),
clusters AS (SELECT anchor AS t_us, count(DISTINCT template_id) AS n_templates, max(per_chan) AS best_per_chan, first(template_id ORDER BY per_chan DESC, t_us, det_id) AS best_template
  FROM strong s ASOF JOIN ({anchors('strong', 60_000_000)}) a ON s.t_us >= a.anchor GROUP BY anchor),
clustered AS (SELECT * FROM clusters WHERE n_templates >= 2 OR best_per_chan >= 0.65),
kept AS (SELECT * FROM clustered k WHERE NOT EXISTS (SELECT 1 FROM v_catalog c WHERE c.review_status = 'confirmed' AND abs(c.t_us - k.t_us) <= 60000000))"""
JOB11 = f"{CANDIDATES} SELECT *, (t_us // 3600000000) % 24 AS hr_utc FROM kept"
JOB12 = f"""{CANDIDATES}, free AS (SELECT *, 'tm' || strftime(make_timestamp(t_us), '%Y%m%dT%H%M%S') AS base FROM kept k WHERE NOT EXISTS (SELECT 1 FROM v_catalog c WHERE abs(c.t_us - k.t_us) <= 5000000))
SELECT base || CASE WHEN row_number() OVER (PARTITION BY base ORDER BY t_us) > 1 THEN '-' || row_number() OVER (PARTITION BY base ORDER BY t_us) ELSE '' END AS event_id, t_us, n_templates, best_template FROM free"""
AG28 = f"""{CANDIDATES} SELECT step, n, 0.5 AS least, 60.0 AS width_s FROM (SELECT 'raw' AS step, count(*) AS n FROM v_detections UNION ALL SELECT 'strong', count(*) FROM strong
UNION ALL SELECT 'clustered', count(*) FROM clustered UNION ALL SELECT 'kept', count(*) FROM kept)"""
JN07 = f"""SELECT k.event_id AS event_id, k.old_id AS old_id, k.gap_us AS gap_us FROM (SELECT unnest({walk(struct('event_id', 'old_id', 'gap_us'), 'gap_us, event_id, old_id', 'y.event_id = x[1].event_id OR y.old_id = x[1].old_id')}) AS k
FROM (SELECT a.event_id, b.event_id AS old_id, abs(a.t_us - b.t_us) AS gap_us FROM v_primary a JOIN v_secondary b ON abs(a.t_us - b.t_us) <= 600000000))"""
JN21 = """, t AS (SELECT 'ep_t' || n AS template_id, t_us + 4000000 AS t_us FROM v_catalog WHERE event_type = 'quarry_blast'),
best AS (SELECT template_id, first(event_id ORDER BY abs(e.t_us - t.t_us), event_id) AS event_id FROM t JOIN v_catalog e ON abs(e.t_us - t.t_us) <= 10000000 GROUP BY 1)
SELECT template_id, event_id, CASE WHEN event_id IS NULL THEN NULL WHEN r = 1 THEN event_id ELSE event_id || '_' || r END AS name FROM t LEFT JOIN
(SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY (template_id <> event_id)::INT, template_id) AS r FROM best) USING (template_id)"""
WN10 = """, s AS (SELECT series, idx, value, max(idx) OVER (PARTITION BY series) + 1 AS n FROM v_series), m AS (SELECT series, any_value(n) AS n, CAST(ceil(any_value(n) / 20.0e0) AS BIGINT) - 1 AS last FROM s GROUP BY series),
p AS (SELECT series, knot, pos, n, last FROM (SELECT series, n, last, unnest(range(1, last + 1)) AS knot FROM m), unnest(range(-20, 20)) u(pos)),
knots AS (SELECT p.series, knot, avg(s.value) AS mean, stddev_pop(s.value) AS std FROM p JOIN s ON s.series = p.series AND s.idx = CASE WHEN knot * 20 + pos < p.n THEN knot * 20 + pos ELSE 2 * (p.n - 1) - knot * 20 - pos END GROUP BY 1, 2),
alive AS (SELECT series, 1 AS a FROM knots WHERE std > 0 GROUP BY 1),
b AS (SELECT s.*, last, idx // 20 AS b, least(greatest(idx // 20, 1), last) AS lo, least(greatest(idx // 20 + 1, 1), last) AS hi FROM s JOIN m USING (series)),
f AS (SELECT b.*, l.mean AS m0, l.std AS s0, h.mean AS m1, h.std AS s1, (idx - b * 20) / (least((b + 1) * 20, n) - b * 20)::DOUBLE AS f, a FROM b
  LEFT JOIN knots l ON l.series = b.series AND l.knot = lo LEFT JOIN knots h ON h.series = b.series AND h.knot = hi LEFT JOIN alive ON alive.series = b.series)
SELECT series, idx, round((value - coalesce(m0 + (m1 - m0) * f, 0)) / CASE WHEN coalesce(s0 + (s1 - s0) * f, 0) > 0 THEN s0 + (s1 - s0) * f ELSE 1 END * CASE WHEN a = 1 THEN 3.0e0 ELSE 1.0e0 END, 6) AS normalised FROM f"""
ARR03 = "SELECT vec_id AS key, min(t) AS start_us, count(*) AS n FROM (SELECT vec_id, start_us * 100 + unnest(range(len(samples))) * 10000 AS t FROM v_traces) GROUP BY vec_id, t // 86400000000"
ARR10 = """SELECT vec_id AS key, first, round((list_max(w) - list_avg(w)) / CASE WHEN list_stddev_pop(w) > 0 THEN list_stddev_pop(w) ELSE 1 END / 10, 6) AS peak
FROM (SELECT vec_id, first, list_transform(samples[first + 1:first + 30], lambda x: x::DOUBLE) AS w FROM v_traces, unnest([0, 20, 34]) u(first))"""
WAVE = "list_transform(samples, lambda u: u::DOUBLE)"
LEVEL = "list_transform(samples, lambda u: u::DOUBLE - list_avg(list_transform(samples, lambda z: z::DOUBLE)))"
ARR11 = f"SELECT vec_id AS key, round(list_max({sections(WAVE, 'high', 2.0, 100.0)}), 6) AS peak FROM v_traces"
ARR12 = f"SELECT vec_id AS key, round(list_max({both_ways('h', 'low', 20.0, 100.0)}), 6) AS peak FROM (SELECT vec_id, {both_ways('x', 'high', 2.0, 100.0)} AS h FROM (SELECT vec_id, {LEVEL} AS x FROM v_traces))"
ARR13 = f"""SELECT vec_id AS key, 50.0::DOUBLE AS rate, 32 AS n, round(list_max(list_transform(generate_series(1, 63, 2), lambda i: y[i] + m)), 6) AS peak
FROM (SELECT vec_id, m, {both_ways('x', 'low', 20.0, 100.0)} AS y FROM (SELECT vec_id, {LEVEL} AS x, list_avg({WAVE}) AS m FROM v_traces))"""
ARR16 = """, w AS (SELECT vec_id, frame, hz, samples[frame * 4 + j + 1]::DOUBLE * (0.5 - 0.5 * cos(2 * pi() * j / 15.0e0)) AS x, j FROM v_traces, range(13) a(frame), range(9) b(hz), range(16) c(j)),
p AS (SELECT vec_id, frame, hz, 10 * log10(sum(x * cos(2 * pi() * hz * j / 16.0e0)) ** 2 + sum(x * sin(2 * pi() * hz * j / 16.0e0)) ** 2 + 1e-20) AS power FROM w GROUP BY ALL),
q AS (SELECT vec_id, quantile_cont(power, 0.05) AS lo, quantile_cont(power, 0.99) AS hi FROM p GROUP BY 1)
SELECT vec_id AS key, count(*) AS n, round(avg(least(greatest((power - lo) / greatest(hi - lo, 1e-12), 0), 1)), 6) AS mean FROM p JOIN q USING (vec_id) GROUP BY 1"""
ARR17 = """, x AS (SELECT vec_id // 50 AS chunk, row_number() OVER (PARTITION BY vec_id // 50 ORDER BY vec_id, i) - 1 AS g, samples[i + 1]::DOUBLE AS v FROM v_traces, range(64) r(i)),
t AS (SELECT 't' || vec_id AS template_id, i, (samples[i + 1]::DOUBLE - avg(samples[i + 1]::DOUBLE) OVER w) / (stddev_pop(samples[i + 1]::DOUBLE) OVER w * 64) AS t FROM v_traces, range(64) r(i) WHERE vec_id % 50 = 0 WINDOW w AS (PARTITION BY vec_id)),
d AS (SELECT chunk, g AS idx, stddev_pop(v) OVER w AS sd, count(*) OVER w AS n FROM x WINDOW w AS (PARTITION BY chunk ORDER BY g ROWS BETWEEN CURRENT ROW AND 63 FOLLOWING)),
c AS (SELECT template_id, chunk, g - i AS idx, sum(v * t) AS cc FROM x, t WHERE g >= i GROUP BY ALL),
s AS (SELECT template_id, chunk, idx, cc / sd AS cc FROM c JOIN d USING (chunk, idx) WHERE n = 64), m AS (SELECT template_id, chunk, median(abs(cc)) AS mad FROM s GROUP BY ALL)
SELECT template_id, chunk, idx, round(cc, 4) AS cc FROM s JOIN m USING (template_id, chunk) WHERE cc >= 8.0 * mad"""
ARR20 = f"""SELECT key, k.t_us AS t_us, round(k.probability, 6) AS probability FROM (SELECT key, unnest({walk(struct('t_us', 'probability'), 'probability DESC, t_us', 'abs(y.t_us - x[1].t_us) <= 50000')}) AS k
FROM (SELECT vec_id AS key, start_us + i * 10000 AS t_us, samples[i + 1]::DOUBLE AS probability FROM v_traces, range(1, 63) r(i) WHERE samples[i + 1] >= 0.1e0 AND samples[i + 1] > samples[i] AND samples[i + 1] >= samples[i + 2]) GROUP BY key)"""
JOB10 = """, e AS (SELECT a.event_id AS a, b.event_id AS b FROM v_catalog a JOIN v_catalog b ON a.event_id <> b.event_id AND abs(a.t_us - b.t_us) <= 3600000000
  WHERE sqrt(((b.longitude - a.longitude) * 111.19e0 * cos(radians((a.latitude + b.latitude) / 2))) ** 2 + ((b.latitude - a.latitude) * 111.19e0) ** 2) <= 50),
r(node, seen) AS (SELECT a, b FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a),
g AS (SELECT node, least(min(seen), node) AS root FROM r GROUP BY node),
k AS (SELECT event_id, row_number() OVER (PARTITION BY root ORDER BY (coalesce(review_status, '') = 'confirmed') DESC, (review_status IS NOT NULL) DESC, num_picks DESC, event_id) AS place FROM v_catalog JOIN g ON node = event_id)
SELECT event_id, CASE WHEN place > 1 THEN 'dropped' ELSE 'kept' END AS what FROM v_catalog LEFT JOIN k USING (event_id)"""
MODEL = ", ".join(f"('{phase}', {-1e9 if i == 0 else top!r}::DOUBLE, {LAYERS[i + 1][0] if i + 1 < len(LAYERS) else 1e9!r}::DOUBLE, {v!r}::DOUBLE)" for i, (top, vp, vs) in enumerate(LAYERS) for phase, v in (("P", vp), ("S", vs)))
JOB13 = f""", model(phase, top, bottom, v) AS (VALUES {MODEL}), depths AS (SELECT DISTINCT depth_km FROM v_catalog), want AS (SELECT DISTINCT round(k::DOUBLE) AS distance_km FROM v_catalog),
parts AS (SELECT depth_km, phase, v, greatest(least(bottom, greatest(depth_km, 0)) - greatest(top, least(depth_km, 0)), 0) AS dz FROM depths, model
  WHERE (top < greatest(depth_km, 0) AND bottom > least(depth_km, 0)) OR (depth_km = 0 AND top <= 0 AND 0 < bottom)),
fastest AS (SELECT phase, depth_km, 0.9999e0 / max(v) AS p_max FROM parts GROUP BY ALL),
rays AS (SELECT phase, depth_km, i, sum(dz * p * v / sqrt(1 - (p * v) ** 2)) AS x, sum(dz / (v * sqrt(1 - (p * v) ** 2))) AS t
  FROM (SELECT phase, depth_km, i, p_max * (i / 799.0e0) ** 1.5e0 AS p FROM fastest, range(800) r(i)) JOIN parts USING (phase, depth_km) GROUP BY ALL),
pair AS (SELECT *, lead(x) OVER w AS x2, lead(t) OVER w AS t2 FROM rays WINDOW w AS (PARTITION BY phase, depth_km ORDER BY i)),
hit AS (SELECT phase, depth_km, distance_km, min(t + (t2 - t) * CASE WHEN x2 > x THEN (distance_km - x) / (x2 - x) ELSE 0 END) AS t FROM pair, want WHERE x2 IS NOT NULL AND distance_km BETWEEN x AND x2 GROUP BY ALL)
SELECT phase, depth_km, distance_km, round(t, 5) AS t FROM (SELECT phase, depth_km, distance_km FROM fastest, want) LEFT JOIN hit USING (phase, depth_km, distance_km)"""
JOB06 = """, n AS (SELECT CASE n % 2 WHEN 0 THEN 'ep' ELSE 'po' END AS source, *, strftime(make_timestamp(t_us), '%Y%m%dT%H%M%S') AS second FROM v_catalog WHERE day >= DATE '2024-01-15'),
m AS (SELECT event_id AS was, source || second || CASE WHEN row_number() OVER w > 1 THEN '-' || row_number() OVER w ELSE '' END AS event_id, t_us FROM n WINDOW w AS (PARTITION BY source, second ORDER BY t_us, n)),
u AS (SELECT event_id AS was, event_id, t_us FROM v_catalog WHERE day < DATE '2024-01-15' UNION ALL SELECT * FROM m)
SELECT u.event_id, t_us, coalesce(p, 0) AS picks FROM u LEFT JOIN (SELECT event_id AS was, count(*) AS p FROM v_assignments GROUP BY 1) USING (was)"""
#: Reviewed events by n % 3: renamed and a second later, an hour later under their own id, or a second later.
JN25 = f""", snap AS (SELECT event_id AS was, CASE WHEN n % 3 = 1 THEN 'rv' || n ELSE event_id END AS old_id, n % 3 > 0 AS lost, t_us + CASE WHEN n % 3 = 2 THEN 3600000000 ELSE 1000000 END AS old_us, n % 3 = 2 AS known, review_status FROM v_catalog WHERE review_status IS NOT NULL),
free AS (SELECT event_id, t_us FROM v_catalog WHERE event_id NOT IN (SELECT old_id FROM snap WHERE NOT lost)),
tw AS (SELECT unnest({walk(struct('old_id', 'event_id'), 't_us, old_id, event_id', 'y.old_id = x[1].old_id OR y.event_id = x[1].event_id')}) AS k FROM (SELECT old_id, event_id, f.t_us FROM snap JOIN free f ON abs(old_us - f.t_us) <= 10000000 AND old_id <> event_id WHERE lost)),
o AS (SELECT CASE WHEN known THEN coalesce(k.event_id, old_id || '-2') ELSE old_id END AS event_id, old_us AS t_us, review_status FROM snap LEFT JOIN tw ON k.old_id = snap.old_id)
SELECT event_id, t_us, NULL AS review_status FROM free WHERE event_id NOT IN (SELECT k.event_id FROM tw) UNION ALL SELECT * FROM o"""


def first_free(rank: str, used: str) -> str:
    """The number of that ``rank`` among the positive ones that list ``used`` does not have."""
    return f"list_filter(range(1, {rank} + len({used}) + 1), lambda x: NOT list_contains({used}, x))[{rank}]"


#: A rebuild in which all origins of an hour fall into one second, earlier ids carried over, and reviewed events by k % 12 moved (0), renamed (4), or as they were (8).
JOB06_REBUILD = f""", c AS (SELECT * EXCLUDE (event_id), CASE n % 2 WHEN 0 THEN 'ep' ELSE 'po' END AS source, t_us // 3600000000 * 3600000000 AS hour_us FROM v_catalog),
f AS (SELECT *, hour_us + n % 997 * 1000 AS now_us, source || strftime(make_timestamp(hour_us), '%Y%m%dT%H%M%S') AS base FROM c),
prev AS (SELECT n, k, source, hour_us, base, old_us, number, base || CASE WHEN number > 1 THEN '-' || number ELSE '' END AS old_id
  FROM (SELECT *, hour_us + n * 7919 % 9973 * 1000 AS old_us, row_number() OVER (PARTITION BY base ORDER BY n) AS number FROM f WHERE k % 2 = 0)),
snap AS (SELECT n, CASE WHEN k % 12 = 4 THEN 'rv' || n ELSE old_id END AS old_id, old_us + CASE WHEN k % 12 = 0 THEN 1200000000 ELSE 0 END AS old_us FROM prev WHERE k % 4 = 0),
used AS (SELECT base, list(DISTINCT number) AS used FROM prev GROUP BY 1),
minted AS (SELECT *, base || CASE WHEN number > 1 THEN '-' || number ELSE '' END AS event_id FROM (SELECT *, {first_free('r', 'u')} AS number
  FROM (SELECT f.*, coalesce(used, []) AS u, row_number() OVER (PARTITION BY base ORDER BY now_us, n) AS r FROM f LEFT JOIN used USING (base)))),
carried AS (SELECT unnest({walk(struct('event_id', 'old_id', 'gap_us'), 'gap_us, event_id, old_id', 'y.event_id = x[1].event_id OR y.old_id = x[1].old_id')}) AS p
  FROM (SELECT m.base, event_id, old_id, abs(now_us - old_us) AS gap_us FROM minted m JOIN prev USING (base) WHERE abs(now_us - old_us) <= 10000000) GROUP BY base),
now AS (SELECT m.event_id AS was, m.n, now_us, coalesce(p.old_id, m.event_id) AS event_id FROM minted m LEFT JOIN carried ON p.event_id = m.event_id),
met AS (SELECT s.*, now.event_id IS NOT NULL AS known, coalesce(abs(now_us - old_us) <= 10000000, false) AS same FROM snap s LEFT JOIN now ON now.event_id = s.old_id),
free AS (SELECT * FROM now WHERE event_id NOT IN (SELECT old_id FROM met WHERE same)),
twins AS (SELECT unnest({walk(struct('old_id', 'event_id'), 'now_us, old_id, event_id', 'y.old_id = x[1].old_id OR y.event_id = x[1].event_id')}) AS p
  FROM (SELECT old_us // 3600000000 AS h, old_id, event_id, now_us FROM met JOIN free ON abs(old_us - now_us) <= 10000000 AND old_id <> event_id AND old_us // 3600000000 = now_us // 3600000000 WHERE NOT same) GROUP BY h),
ids AS (SELECT event_id FROM now UNION SELECT old_id FROM snap),
tail AS (SELECT regexp_extract(event_id, '^(.*)-([0-9]+)$', 1) AS old_id, list(regexp_extract(event_id, '^(.*)-([0-9]+)$', 2)::INT) AS u FROM ids WHERE regexp_matches(event_id, '^(.*)-([0-9]+)$') GROUP BY 1),
out AS (SELECT m.n, old_us, m.old_id, p.event_id AS twin, CASE WHEN same OR NOT known THEN m.old_id WHEN p.event_id IS NOT NULL THEN p.event_id
  ELSE m.old_id || '-' || {first_free('1', 'list_append(coalesce(u, []), 1)')} END AS event_id, same FROM met m LEFT JOIN twins ON p.old_id = m.old_id LEFT JOIN tail ON tail.old_id = m.old_id),
gone AS (SELECT old_id AS event_id FROM out WHERE same UNION ALL SELECT twin FROM out WHERE twin IS NOT NULL),
a AS (SELECT n, count(*) AS picks FROM v_assignments JOIN v_catalog USING (event_id) GROUP BY 1)
SELECT event_id, now_us AS t_us, false AS reviewed, coalesce(picks, 0) AS picks FROM now LEFT JOIN a USING (n) WHERE event_id NOT IN (FROM gone) UNION ALL SELECT event_id, old_us, true, 1 FROM out"""

#: Ten adjoining traces filtered as one.
JOIN10 = "SELECT vec_id // 10 AS g, flatten(list(samples ORDER BY vec_id)) AS samples FROM v_traces GROUP BY 1"
ARR12_CHUNKS = f"""SELECT vec_id AS key, round(list_max(y[(vec_id % 10) * 64 + 1:(vec_id % 10) * 64 + 64]), 6) AS peak FROM v_traces JOIN (SELECT g, {both_ways('h', 'low', 20.0, 100.0)} AS y
FROM (SELECT g, {both_ways('x', 'high', 2.0, 100.0)} AS h FROM (SELECT g, {LEVEL} AS x FROM ({JOIN10})))) ON g = vec_id // 10"""
#: Chunks of 320 samples with 50 of context, of keys of a hundred traces.
ARR09_PADDED = """, x AS (SELECT vec_id // 100 AS key, vec_id * 64 + i AS g, samples[i + 1]::DOUBLE AS v FROM v_traces, range(64) r(i)),
c AS (SELECT DISTINCT g // 320 AS c FROM x)
SELECT key, 1704067200000000 + c * 3200000 AS start_us, count(*) AS valid, round(sum(v), 5) AS total, count(*) FILTER (g // 320 = c) AS own FROM x JOIN c ON g BETWEEN c * 320 - 50 AND c * 320 + 369 GROUP BY key, c"""
#: Three channels with offsets, days of 250 traces in chunks of 50; the median is the day's.
ARR17_DAYS = """, x AS (SELECT vec_id // 250 AS day, channel, vec_id % 250 * 64 + i AS g, CASE channel WHEN 'E' THEN samples[i + 1]::DOUBLE WHEN 'N' THEN samples[64 - i]::DOUBLE ELSE samples[i + 1]::DOUBLE * samples[i + 1]::DOUBLE END AS v
  FROM v_traces, range(64) r(i), (VALUES ('E'), ('N'), ('Z')) c(channel)),
u AS (SELECT 't' || vec_id AS template_id, channel, shift, i, CASE channel WHEN 'E' THEN samples[i + 1]::DOUBLE WHEN 'N' THEN samples[64 - i]::DOUBLE ELSE samples[i + 1]::DOUBLE * samples[i + 1]::DOUBLE END AS v
  FROM v_traces, range(64) r(i), (VALUES ('E', 0), ('N', 3), ('Z', -2)) c(channel, shift) WHERE vec_id % 50 = 0),
t AS (SELECT *, (v - avg(v) OVER w) / (stddev_pop(v) OVER w * 64) AS t FROM u WINDOW w AS (PARTITION BY template_id, channel)),
d AS (SELECT day, channel, g, stddev_pop(v) OVER w AS sd, count(*) OVER w AS n FROM x WINDOW w AS (PARTITION BY day, channel ORDER BY g ROWS BETWEEN CURRENT ROW AND 63 FOLLOWING)),
c AS (SELECT template_id, day, channel, shift, g - i AS g, sum(x.v * t) AS cc FROM x JOIN t USING (channel) WHERE g >= i GROUP BY ALL),
s AS (SELECT template_id, day, g - shift AS idx, sum(cc / sd) AS cc, count(*) AS n_chans FROM c JOIN d USING (day, channel, g) WHERE n = 64 AND g >= shift GROUP BY ALL),
m AS (SELECT template_id, day, median(abs(cc)) AS mad FROM s GROUP BY ALL)
SELECT template_id, day, idx, n_chans, round(cc, 4) AS cc, round(mad, 5) AS mad FROM s JOIN m USING (template_id, day) WHERE cc >= 7.0 * mad"""

#: Chunks of 320 samples with 50 of context, windows of 120 every 80 (the last at the end), a fixed score in steps of 1/64 for two phases, their mean, maxima
#: inside the chunk, and of those within 50 ms the most probable.
UDF01 = f""", x AS (SELECT vec_id // 100 AS key, vec_id * 64 + i AS g, samples[i + 1]::DOUBLE AS v FROM v_traces, range(64) r(i)),
c AS (SELECT DISTINCT key, g // 320 AS c FROM (SELECT key, g + d AS g FROM x, (VALUES (-50), (50), (0)) y(d)) JOIN (SELECT DISTINCT g // 320 AS c FROM x) ON g // 320 = c),
p AS (SELECT c.key, c, i, coalesce(v, 0) AS v FROM c CROSS JOIN range(420) r(i) LEFT JOIN x ON x.key = c.key AND x.g = c * 320 - 50 + i),
w AS (SELECT key, c, first, i - first AS j, v, avg(v) OVER q AS m, stddev_pop(v) OVER q AS sd FROM p JOIN (VALUES (0), (80), (160), (240), (300)) f(first) ON i >= first AND i < first + 120 WINDOW q AS (PARTITION BY key, c, first)),
s AS (SELECT key, c, first + j AS i, phase, CASE phase WHEN 'P' THEN floor(least(abs(z) * 3, 1) * 64) / 64 ELSE floor(least(greatest(-z, 0) * 4, 1) * 64) / 64 END AS v
  FROM (SELECT *, (v - m) / CASE WHEN sd > 0 THEN sd ELSE 1 END / 10 AS z FROM w), (VALUES ('P'), ('S')) h(phase)),
a AS (SELECT key, c, i, phase, sum(v) / count(*) AS v FROM s GROUP BY ALL),
t AS (SELECT *, lag(v) OVER q AS before, lead(v) OVER q AS after FROM a WINDOW q AS (PARTITION BY key, c, phase ORDER BY i)),
k AS (SELECT key, phase, 1704067200000000 + (c * 320 - 50 + i) * 10000 AS t_us, v AS probability FROM t WHERE v >= 0.7e0 AND v > before AND v >= after AND i >= 50 AND i < 370)
SELECT key, phase, k.t_us AS t_us, round(k.probability, 6) AS probability FROM (SELECT key, phase, unnest({walk(struct('t_us', 'probability'), 'probability DESC, t_us', 'abs(y.t_us - x[1].t_us) <= 50000')}) AS k FROM k GROUP BY key, phase)"""

#: Samples beyond 0.3 bridged, trend off, five percent tapered, trimmed to epochs that begin ten samples in for every third key, halved.
JOB02 = """, x AS (SELECT vec_id AS key, start_us, i, CASE WHEN abs(samples[i + 1]::DOUBLE) <= 0.3e0 THEN samples[i + 1]::DOUBLE END AS ok FROM v_traces, range(64) r(i)),
g AS (SELECT *, CASE WHEN ok IS NOT NULL THEN i END AS here FROM x),
b AS (SELECT *, min(here) OVER (PARTITION BY key) AS a, max(here) OVER (PARTITION BY key) AS z FROM g),
f AS (SELECT *, last_value(ok IGNORE NULLS) OVER p AS v0, last_value(here IGNORE NULLS) OVER p AS i0, first_value(ok IGNORE NULLS) OVER q AS v1, first_value(here IGNORE NULLS) OVER q AS i1 FROM b WHERE i BETWEEN a AND z
  WINDOW p AS (PARTITION BY key ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), q AS (PARTITION BY key ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
y AS (SELECT key, start_us, a, i - a AS j, z - a + 1 AS n, CASE WHEN ok IS NOT NULL THEN ok ELSE v0 + (v1 - v0) * (i - i0) / (i1 - i0) END AS y FROM f),
d AS (SELECT y.*, y - c0 - c1 * j AS r, floor(n * 0.05e0) AS m, CASE WHEN y.key % 3 = 0 AND a < 10 THEN 10 - a ELSE 0 END AS skip
  FROM y JOIN (SELECT key, regr_intercept(y, j) AS c0, regr_slope(y, j) AS c1 FROM y GROUP BY key) USING (key) WHERE n >= 10),
t AS (SELECT *, r * CASE WHEN j < m THEN 0.5e0 - 0.5e0 * cos(pi() * j / m) WHEN j >= n - m THEN 0.5e0 - 0.5e0 * cos(pi() * (n - 1 - j) / m) ELSE 1 END AS v FROM d WHERE n - skip >= 10 AND j >= skip)
SELECT key, min(start_us + (a + j) * 10000) AS start_us, count(*)::INT AS n, round(max((v / 2)::FLOAT::DOUBLE), 5) AS peak FROM t GROUP BY key"""
