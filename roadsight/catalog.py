"""Registered queries: name → (Spark builder, DuckDB oracle SQL or None).

Each builder takes ``(spark, sf_dir)`` and reads whole driver tables through
``roadsight.sources.testbed``.  Oracle SQL runs on DuckDB over the same
parquet tables; column names are identical on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadsight.operators import speed
from roadsight.sources import testbed as tb
from roadsight.sources.dims import latest_by_key

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, oracle: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, oracle)
        return fn
    return deco


W = tb.sql_with

# ----------------------------------------------------------------- dimensions

@register("monitor_limits", W("limits") + "SELECT * FROM limits")
def q_monitor_limits(spark, d):
    return tb.limits(spark, d)


@register("dim_latest", """
SELECT monitor_id, road_id, speed_limit, area_id, load_seq FROM (
  SELECT *, row_number() OVER (PARTITION BY monitor_id ORDER BY load_seq DESC) AS rn
  FROM (""" + tb.SQL_VIEWS["limits_feed"] + """)) WHERE rn = 1""")
def q_dim_latest(spark, d):
    return latest_by_key(tb.limits_feed(spark, d), "monitor_id", "load_seq")


@register("violation_list", W("watch_list") + "SELECT * FROM watch_list")
def q_violation_list(spark, d):
    from roadsight.session import scratch_dir
    from roadsight.sources.dims import read_violation_list
    path = scratch_dir(spark, "violation-list")
    tb.watch_list(spark, d).write.mode("overwrite").parquet(path)
    return read_violation_list(spark, path)

# --------------------------------------------------------------- speed checks

@register("out_of_speed", W("passes", "limits") + """
SELECT p.car, p.monitor_id, p.road_id, p.speed AS real_speed, l.speed_limit AS limit_speed,
       p.action_time
FROM passes p JOIN limits l ON p.monitor_id = l.monitor_id
WHERE p.speed > l.speed_limit * 1.1e0""")
def q_out_of_speed(spark, d):
    return speed.out_of_speed(tb.passes(spark, d), tb.limits(spark, d))


_WITH_LIMIT_SQL = """
SELECT p.car, p.monitor_id, p.road_id, p.speed AS real_speed,
       coalesce(l.speed_limit, 80) AS limit_speed, p.action_time
FROM passes p LEFT JOIN limits l ON p.monitor_id = l.monitor_id"""


@register("passes_with_limit", W("passes", "limits") + _WITH_LIMIT_SQL)
def q_passes_with_limit(spark, d):
    return speed.with_limit(tb.passes(spark, d), tb.limits(spark, d))


@register("speeding_20pct", W("passes", "limits") + "SELECT * FROM (" + _WITH_LIMIT_SQL
          + ") WHERE real_speed > limit_speed * 1.2e0")
def q_speeding_20pct(spark, d):
    return speed.speeding(speed.with_limit(tb.passes(spark, d), tb.limits(spark, d)), 1.2)

# ------------------------------------------------------------ scans / parsers

_TRAFFIC7 = "action_time, monitor_id, camera_id, car, speed, road_id, area_id"


@register("parse_traffic", W("passes") + f"SELECT {_TRAFFIC7} FROM passes")
def q_parse_traffic(spark, d):
    from roadsight.sources.text import parse_traffic
    return parse_traffic(tb.traffic_lines(spark, d), "value", "strict")


@register("scan_traffic", W("passes") + f"SELECT {_TRAFFIC7} FROM passes")
def q_scan_traffic(spark, d):
    from roadsight.session import scratch_dir
    from roadsight.sources.text import read_traffic
    path = scratch_dir(spark, "traffic-text")
    tb.traffic_lines(spark, d).write.mode("overwrite").text(path)
    return read_traffic(spark, path, "strict")


@register("parse_violation", W("violations") + "SELECT car, violation, create_time, out_count FROM violations")
def q_parse_violation(spark, d):
    from roadsight.sources.text import parse_violation
    return parse_violation(tb.violation_lines(spark, d))


@register("parse_police_action",
          W("police_actions") + "SELECT police_id, car, action_status, action_time FROM police_actions")
def q_parse_police_action(spark, d):
    from roadsight.sources.text import parse_police_action
    return parse_police_action(tb.police_action_lines(spark, d))

# ------------------------------------------------------- watch list / tracks

_TRACK = "car, action_time, monitor_id, road_id, area_id, speed"
_ROW_KEY_SQL = "car || '_' || cast(9223372036854775807 - action_time as varchar)"


@register("car_track", W("passes", "watch_list") + f"""
SELECT row_key, {_TRACK} FROM (
  SELECT {_ROW_KEY_SQL} AS row_key, {_TRACK},
         row_number() OVER (PARTITION BY {_ROW_KEY_SQL} ORDER BY seq DESC) AS rn
  FROM passes WHERE car IN (SELECT car FROM watch_list)) WHERE rn = 1""")
def q_car_track(spark, d):
    from roadsight.operators.watchlist import track_listed_cars
    return track_listed_cars(tb.passes(spark, d), tb.watch_list(spark, d))


@register("violation_king_on_road", W("passes", "watch_list") + f"""
SELECT {_TRACK} FROM passes WHERE car IN (
  SELECT car FROM watch_list
  WHERE try_cast(regexp_extract(violation, '([0-9]+)次', 1) AS integer) > 50)""")
def q_violation_king_on_road(spark, d):
    from roadsight.operators.watchlist import listed_passes, to_track, violation_king
    return to_track(listed_passes(tb.passes(spark, d), violation_king(tb.watch_list(spark, d)))).drop("seq")


@register("cloned_car_track", W("passes", "watch_list") + f"""
SELECT {_TRACK} FROM passes WHERE car IN (
  SELECT car FROM watch_list WHERE violation = '嫌疑套牌车')""")
def q_cloned_car_track(spark, d):
    from roadsight.operators.watchlist import listed_passes, suspected_clones, to_track
    return to_track(listed_passes(tb.passes(spark, d), suspected_clones(tb.watch_list(spark, d)))).drop("seq")


@register("track_latest_n", W("passes") + f"""
SELECT {_TRACK}, rank FROM (
  SELECT {_TRACK}, row_number() OVER (PARTITION BY car ORDER BY action_time DESC, seq DESC) AS rank
  FROM passes) WHERE rank <= 3""")
def q_track_latest_n(spark, d):
    from roadsight.operators.watchlist import latest_tracks
    return latest_tracks(tb.passes(spark, d), 3)


@register("track_batches", W("passes", "watch_list") + f"""
SELECT (rn - 1) // 20 AS batch_id, row_key, {_TRACK} FROM (
  SELECT {_ROW_KEY_SQL} AS row_key, {_TRACK},
         row_number() OVER (ORDER BY action_time, seq) AS rn, count(*) OVER () AS total
  FROM passes WHERE car IN (SELECT car FROM watch_list))
WHERE rn <= (total // 20) * 20""")
def q_track_batches(spark, d):
    from roadsight.operators.watchlist import listed_passes, to_track, track_batches
    tracks = to_track(listed_passes(tb.passes(spark, d), tb.watch_list(spark, d)))
    return track_batches(tracks, 20, emit_partial=False).drop("seq")

# ---------------------------------------------------------- windowed stats

_CENTS_AVG = "cast((2 * sum(cast(round(speed * 100) as bigint)) + count(*)) // (2 * count(*)) as double) / 100"
_SLIDING = """
  SELECT p.*, w.start_time FROM passes p,
  LATERAL (SELECT (p.action_time - p.action_time % 60000) - k * 60000 AS start_time
           FROM range(0, 5) t(k)) w"""

AVG_SPEED_SQL = W("passes") + f"""
SELECT start_time, start_time + 300000 AS end_time, monitor_id,
       {_CENTS_AVG} AS avg_speed, cast(count(*) as integer) AS car_count
FROM ({_SLIDING}) GROUP BY start_time, monitor_id"""


@register("avg_speed_sliding", AVG_SPEED_SQL)
def q_avg_speed_sliding(spark, d):
    from roadsight.operators.flow import avg_speed
    return avg_speed(tb.passes(spark, d), "5 minutes", "1 minute")


@register("checkpoint_flow", W("passes") + f"""
SELECT start_time, start_time + 300000 AS end_time, monitor_id, cast(count(*) as integer) AS car_count
FROM ({_SLIDING}) GROUP BY start_time, monitor_id""")
def q_checkpoint_flow(spark, d):
    from roadsight.operators.flow import flow
    return flow(tb.passes(spark, d), "5 minutes", "1 minute")


TOP3_SQL = f"""
SELECT start_time, end_time, rank, monitor_id, avg_speed, car_count FROM (
  SELECT *, row_number() OVER (PARTITION BY start_time, end_time
                               ORDER BY avg_speed DESC, monitor_id) AS rank
  FROM ({AVG_SPEED_SQL})) WHERE rank <= 3"""


@register("top3_free_flowing", TOP3_SQL)
def q_top3_free_flowing(spark, d):
    from roadsight.operators.flow import avg_speed, top_n_avg_speed
    return top_n_avg_speed(avg_speed(tb.passes(spark, d)), 3)


@register("top3_free_flowing_text", f"""
SELECT start_time, end_time,
       '在时间从' || cast(start_time as varchar) || '，到:' || cast(end_time as varchar)
       || '的时间范围内：整个城市最通畅的前三个卡口为：'
       || string_agg('卡口编号：' || monitor_id || '，平均车速：' || cast(avg_speed as varchar)
                     || '，经过的车数量：' || cast(car_count as varchar), '' ORDER BY rank) AS alert_text
FROM ({TOP3_SQL}) GROUP BY start_time, end_time""")
def q_top3_free_flowing_text(spark, d):
    from roadsight.operators.flow import avg_speed, top_n_avg_speed, top_n_text
    return top_n_text(top_n_avg_speed(avg_speed(tb.passes(spark, d)), 3))


def _area_sql(count_expr: str, source: str = "passes") -> str:
    return W("passes") + f"""
SELECT start_time, end_time, area_id, car_count,
       '区域id：' || area_id || '，时间范围为【起始时间：' || cast(start_time as varchar)
       || '----结束时间：' || cast(end_time as varchar) || '】，一共上路的车辆为'
       || cast(car_count as varchar) AS alert_text
FROM (SELECT action_time - action_time % 30000 AS start_time,
             action_time - action_time % 30000 + 30000 AS end_time, area_id,
             cast({count_expr} as integer) AS car_count
      FROM {source} GROUP BY 1, 2, 3)"""


@register("area_vehicle_count", _area_sql("count(DISTINCT car)"))
def q_area_vehicle_count(spark, d):
    from roadsight.operators.flow import area_vehicles
    return area_vehicles(tb.passes(spark, d).drop("seq"), "30 seconds", "car")


@register("area_record_count", _area_sql(
    "count(DISTINCT (action_time, monitor_id, camera_id, car, speed, road_id, area_id))"))
def q_area_record_count(spark, d):
    from roadsight.operators.flow import area_vehicles
    return area_vehicles(tb.passes(spark, d).drop("seq"), "30 seconds", "record")


@register("area_vehicle_bitmap", _area_sql("count(DISTINCT car)"))
def q_area_vehicle_bitmap(spark, d):
    from roadsight.operators.flow import area_vehicles_bitmap
    return area_vehicles_bitmap(tb.passes(spark, d), "30 seconds", 1 << 25)


@register("area_vehicle_bitmap_built", _area_sql("count(DISTINCT car)"))
def q_area_vehicle_bitmap_built(spark, d):
    """Counts read back from the bitmaps themselves."""
    from roadsight.operators.flow import area_vehicles_bitmap
    built = area_vehicles_bitmap(tb.passes(spark, d), "30 seconds", 1 << 25, materialize=True)
    return built.drop("bitmap")   # the count is read from the bitmap


@register("area_vehicle_approx_bound", W("passes") + """
SELECT action_time - action_time % 30000 AS start_time, area_id,
       cast(count(DISTINCT car) as integer) AS car_count, true AS within_bound
FROM passes GROUP BY 1, 2""")
def q_area_vehicle_approx_bound(spark, d):
    """The exact count, and whether the estimate is within five standard errors of it."""
    from roadsight.operators.flow import area_vehicles
    passes = tb.passes(spark, d).drop("seq")
    exact = area_vehicles(passes, "30 seconds", "car").select("start_time", "area_id", "car_count")
    guess = area_vehicles(passes, "30 seconds", "approx").select(
        "start_time", "area_id", F.col("car_count").alias("guess"))
    near = F.abs(F.col("guess") - F.col("car_count")) <= F.greatest(F.lit(1.0), F.col("car_count") * 0.1)
    return exact.join(guess, ["start_time", "area_id"]).withColumn("within_bound", near).drop("guess")


@register("area_vehicle_approx", None)
def q_area_vehicle_approx(spark, d):
    from roadsight.operators.flow import area_vehicles
    return area_vehicles(tb.passes(spark, d).drop("seq"), "30 seconds", "approx")


@register("area_vehicle_named", W("passes") + """
SELECT c.*, a.area_name FROM (""" + _area_sql("count(DISTINCT car)").replace(W("passes"), "") + """) c
LEFT JOIN (VALUES ('01', '海淀区'), ('02', '昌平区'), ('03', '朝阳区'), ('04', '顺义区'),
                  ('05', '西城区'), ('06', '东城区'), ('07', '大兴区'), ('08', '石景山'))
          a(area_id, area_name) ON c.area_id = a.area_id""")
def q_area_vehicle_named(spark, d):
    from roadsight.operators.flow import area_vehicles, with_area_name
    return with_area_name(area_vehicles(tb.passes(spark, d).drop("seq"), "30 seconds", "car"))


@register("area_vehicle_running", W("passes") + """
SELECT start_time, end_time, area_id, car, action_time, seq, is_new,
       sum(CAST(is_new AS integer)) OVER (PARTITION BY area_id, start_time ORDER BY action_time, seq
                                          ROWS UNBOUNDED PRECEDING) AS running_count
FROM (SELECT action_time - action_time % 30000 AS start_time,
             action_time - action_time % 30000 + 30000 AS end_time, area_id, car, action_time, seq,
             row_number() OVER (PARTITION BY area_id, action_time - action_time % 30000, car
                                ORDER BY action_time, seq) = 1 AS is_new
      FROM passes)""")
def q_area_vehicle_running(spark, d):
    from roadsight.operators.flow import area_vehicles_running
    return area_vehicles_running(tb.passes(spark, d), 30_000)

# ------------------------------------------------------------ keyed state

CLONED_SQL = W("passes") + """
SELECT car, pm AS first_monitor, monitor_id AS second_monitor, pt AS first_time,
       action_time AS warning_time, '涉嫌套牌车' AS warning_msg
FROM (SELECT *, row_number() OVER (PARTITION BY car, isl ORDER BY action_time, seq) AS rn
      FROM (SELECT *, sum(CASE WHEN pt IS NULL OR action_time - pt >= 10000 THEN 1 ELSE 0 END)
                        OVER (PARTITION BY car ORDER BY action_time, seq ROWS UNBOUNDED PRECEDING) AS isl
            FROM (SELECT car, monitor_id, action_time, seq,
                         lag(action_time) OVER (PARTITION BY car ORDER BY action_time, seq) AS pt,
                         lag(monitor_id) OVER (PARTITION BY car ORDER BY action_time, seq) AS pm
                  FROM passes)))
WHERE rn % 2 = 0"""


@register("cloned_plate", CLONED_SQL)
def q_cloned_plate(spark, d):
    from roadsight.operators.clone import cloned_plate
    return cloned_plate(tb.passes(spark, d), 10_000)


@register("clone_to_violation",
          "SELECT car, warning_msg AS violation, warning_time AS create_time FROM (" + CLONED_SQL + ")")
def q_clone_to_violation(spark, d):
    from roadsight.operators.clone import clone_to_violation, cloned_plate
    return clone_to_violation(cloned_plate(tb.passes(spark, d), 10_000))


_SPEEDING_SQL = """
  SELECT car, action_time, seq, monitor_id, real_speed, limit_speed,
         row_number() OVER (PARTITION BY car ORDER BY action_time, seq) AS idx
  FROM (""" + _WITH_LIMIT_SQL.replace("p.action_time", "p.action_time, p.seq") + """)
  WHERE real_speed > limit_speed * 1.2e0"""


def _danger_sql(all_matches: bool) -> str:
    ends = f"""
    SELECT car, idx, action_time,
           min(idx) OVER (PARTITION BY car ORDER BY action_time
                          RANGE BETWEEN 119999 PRECEDING AND CURRENT ROW) AS lo
    FROM sp"""
    if all_matches:
        matches = "SELECT e.car, s.idx AS s_idx, e.idx AS e_idx FROM ends e JOIN sp s ON s.car = e.car AND s.idx BETWEEN e.lo AND e.idx - 2"
    else:
        matches = "SELECT car, lo AS s_idx, idx AS e_idx FROM ends WHERE idx - lo + 1 >= 3"
    return W("passes", "limits") + f""", sp AS ({_SPEEDING_SQL}), ends AS ({ends}), m AS ({matches})
SELECT m.car, min(x.action_time) AS start_time, max(x.action_time) AS end_time,
       cast(count(*) as integer) AS pass_count,
       cast((2 * sum(cast(round(x.real_speed * 100) as bigint)) + count(*)) // (2 * count(*)) as double) / 100 AS avg_speed,
       '当前车辆' || m.car || '，涉嫌危险驾驶，它在两分钟内经过的卡口数为：' || cast(count(*) as varchar)
       || string_agg('第' || cast(x.idx - m.s_idx + 1 as varchar) || '个卡口' || x.monitor_id
                     || '，车速为：' || cast(x.real_speed as varchar) || '，该卡口的限速为：'
                     || cast(x.limit_speed as varchar), '' ORDER BY x.idx)
       || '它在两分钟内的平均车速为：'
       || cast(cast((2 * sum(cast(round(x.real_speed * 100) as bigint)) + count(*)) // (2 * count(*)) as double) / 100 as varchar) AS violation
FROM m JOIN sp x ON x.car = m.car AND x.idx BETWEEN m.s_idx AND m.e_idx
GROUP BY m.car, m.s_idx, m.e_idx"""


@register("dangerous_car_all", _danger_sql(True))
def q_dangerous_car_all(spark, d):
    from roadsight.operators.danger import dangerous_car
    pw = speed.with_limit(tb.passes(spark, d), tb.limits(spark, d), carry=["seq"])
    return dangerous_car(pw, 3, 120_000, 1.2, emit="all")


@register("dangerous_car_longest", _danger_sql(False))
def q_dangerous_car_longest(spark, d):
    from roadsight.operators.danger import dangerous_car
    pw = speed.with_limit(tb.passes(spark, d), tb.limits(spark, d), carry=["seq"])
    return dangerous_car(pw, 3, 120_000, 1.2, emit="longest")


@register("daily_violation_upsert", W("reports_new", "reports_old") + """
SELECT car, day, violation, create_time, out_count FROM (
  SELECT car, day, violation, create_time,
         max(out_count) OVER (PARTITION BY car, day) AS out_count,
         row_number() OVER (PARTITION BY car, day ORDER BY create_time, violation) AS rn
  FROM (SELECT *, DATE '1970-01-01' + cast(create_time // 86400000 as integer) AS day
        FROM (SELECT * FROM reports_old UNION ALL SELECT * FROM reports_new)))
WHERE rn = 1""")
def q_daily_violation_upsert(spark, d):
    from roadsight.operators.danger import daily_violation_upsert
    return daily_violation_upsert(tb.daily_reports(spark, d, "signup"),
                                  tb.daily_reports(spark, d, "view"))

# ------------------------------------------------------ violation dispatch

INTERVAL_SQL = W("violations", "police_actions") + """
SELECT v.car, v.violation, v.create_time, p.police_id, p.action_status, p.action_time,
       '违法车辆【' || v.car || '】，已经有交警出警了，警号为【' || p.police_id || '】，出警状态为【'
       || p.action_status || '】，出警时间为【' || cast(p.action_time as varchar) || '】' AS alert_text
FROM violations v JOIN police_actions p
  ON v.car = p.car AND p.action_time BETWEEN v.create_time AND v.create_time + 10000"""


@register("violation_action_interval", INTERVAL_SQL)
def q_violation_action_interval(spark, d):
    from roadsight.operators.dispatch import violation_action_interval
    return violation_action_interval(tb.violations(spark, d), tb.police_actions(spark, d))


@register("violation_action_full", W("violations", "police_actions") + """
SELECT CASE WHEN v.car IS NULL THEN 'action_only' WHEN p.car IS NULL THEN 'violation_only'
            ELSE 'matched' END AS outcome,
       coalesce(v.car, p.car) AS car, v.violation, v.create_time,
       p.police_id, p.action_status, p.action_time
FROM violations v FULL OUTER JOIN police_actions p
  ON v.car = p.car AND p.action_time BETWEEN v.create_time AND v.create_time + 10000""")
def q_violation_action_full(spark, d):
    from roadsight.operators.dispatch import classify_violation_action
    return classify_violation_action(tb.violations(spark, d), tb.police_actions(spark, d))


PAIR_SQL = W("violations", "police_actions") + """
, u AS (
  SELECT car, create_time AS t, seq, 'v' AS kind, violation, NULL AS police_id, NULL AS action_status
  FROM violations
  UNION ALL
  SELECT car, action_time, seq, 'p', NULL, police_id, action_status FROM police_actions),
n AS (
  SELECT *, lag(t) OVER w AS pt, lag(kind) OVER w AS pk, lag(violation) OVER w AS pv,
         lag(police_id) OVER w AS ppid, lag(action_status) OVER w AS pst,
         lead(t) OVER w AS nt, lead(kind) OVER w AS nk
  FROM u WINDOW w AS (PARTITION BY car ORDER BY t, seq)),
i AS (
  SELECT *, sum(CASE WHEN pt IS NULL OR t - pt > 5000 OR kind = pk THEN 1 ELSE 0 END)
              OVER (PARTITION BY car ORDER BY t, seq ROWS UNBOUNDED PRECEDING) AS isl,
         (nt IS NULL OR nt - t > 5000 OR nk = kind) AS next_start
  FROM n),
r AS (SELECT *, row_number() OVER (PARTITION BY car, isl ORDER BY t, seq) AS rn FROM i)
SELECT 'matched' AS outcome, CAST(NULL AS varchar) AS reason, car,
       CASE WHEN kind = 'v' THEN violation ELSE pv END AS violation,
       CASE WHEN kind = 'v' THEN t ELSE pt END AS create_time,
       CASE WHEN kind = 'p' THEN police_id ELSE ppid END AS police_id,
       CASE WHEN kind = 'p' THEN action_status ELSE pst END AS action_status,
       CASE WHEN kind = 'p' THEN t ELSE pt END AS action_time
FROM r WHERE rn % 2 = 0
UNION ALL
SELECT CASE WHEN kind = 'v' THEN 'unmatched_violation' ELSE 'unmatched_action' END,
       CASE WHEN nk = kind AND nt - t <= 5000 THEN 'superseded' ELSE 'expired' END, car,
       violation, CASE WHEN kind = 'v' THEN t END, police_id, action_status,
       CASE WHEN kind = 'p' THEN t END
FROM r WHERE rn % 2 = 1 AND next_start"""


@register("pair_violation_action", PAIR_SQL)
def q_pair_violation_action(spark, d):
    from roadsight.operators.dispatch import pair_violation_action
    return pair_violation_action(tb.violations(spark, d), tb.police_actions(spark, d), 5_000)


@register("violation_without_action",
          "SELECT * FROM (" + PAIR_SQL + ") WHERE outcome = 'unmatched_violation'")
def q_violation_without_action(spark, d):
    from roadsight.operators.dispatch import pair_violation_action
    r = pair_violation_action(tb.violations(spark, d), tb.police_actions(spark, d), 5_000)
    return r.filter(F.col("outcome") == "unmatched_violation")


@register("action_without_violation",
          "SELECT * FROM (" + PAIR_SQL + ") WHERE outcome = 'unmatched_action'")
def q_action_without_violation(spark, d):
    from roadsight.operators.dispatch import pair_violation_action
    r = pair_violation_action(tb.violations(spark, d), tb.police_actions(spark, d), 5_000)
    return r.filter(F.col("outcome") == "unmatched_action")


@register("pair_alert_text", "SELECT outcome, car, CASE outcome WHEN 'matched' THEN "
          "'违法车辆【' || car || '】，违法时间【' || cast(create_time as varchar) || '】,已经有交警出警了，警号为【' || police_id "
          "|| '】,出警的状态为【' || action_status || '】,出警的时间为【' || cast(action_time as varchar) || '】' "
          "WHEN 'unmatched_action' THEN '没有对应的违法车辆信息' ELSE '该违法车辆在5分钟内没有交警出警' END AS alert_text "
          "FROM (" + PAIR_SQL + ")")
def q_pair_alert_text(spark, d):
    from roadsight.operators.dispatch import pair_violation_action, pairing_alert
    r = pair_violation_action(tb.violations(spark, d), tb.police_actions(spark, d), 5_000)
    return pairing_alert(r).select("outcome", "car", "alert_text")

# ------------------------------------------- line -> parser -> keyed operator
# Sources give no ``seq``: records of one time are ordered by their own text.


def _by_record(sql: str) -> str:
    """Oracle with the test bed's arrival number replaced by the record's text."""
    for view, columns in (("passes", _TRAFFIC7), ("violations", "car, violation, create_time, out_count"),
                          ("police_actions", "police_id, car, action_status, action_time")):
        text = tb.SQL_VIEWS[view]
        sql = sql.replace(text, text.replace("event_id AS seq", f"concat_ws(chr(31), {columns}) AS seq"))
    return sql


@register("cloned_plate_from_lines", _by_record(CLONED_SQL))
def q_cloned_plate_from_lines(spark, d):
    from roadsight.operators.clone import cloned_plate
    from roadsight.sources.text import parse_traffic
    return cloned_plate(parse_traffic(tb.traffic_lines(spark, d)), 10_000)


@register("pair_violation_action_from_lines", _by_record(PAIR_SQL))
def q_pair_violation_action_from_lines(spark, d):
    from roadsight.operators.dispatch import pair_violation_action
    from roadsight.sources.text import parse_police_action, parse_violation
    return pair_violation_action(parse_violation(tb.violation_lines(spark, d)),
                                 parse_police_action(tb.police_action_lines(spark, d)), 5_000)


@register("dangerous_car_from_lines", _danger_sql(False).replace("p.action_time, p.seq", (
    "p.action_time, concat_ws(chr(31), p.car, p.monitor_id, p.road_id, p.speed, "
    "coalesce(l.speed_limit, 80), p.action_time) AS seq")))
def q_dangerous_car_from_lines(spark, d):
    from roadsight.operators.danger import dangerous_car
    from roadsight.sources.text import parse_traffic
    pw = speed.with_limit(parse_traffic(tb.traffic_lines(spark, d)), tb.limits(spark, d))
    return dangerous_car(pw, 3, 120_000, 1.2, emit="longest")

# -------------------------------------------------------- streaming twins
# Each replays the driver-derived inputs as a time-sliced file stream, runs
# the streaming operator to completion and returns its sink; the oracle is
# the batch oracle.


def _sentinel_traffic(spark, d, name, fmt="parquet"):
    from roadsight.streaming.harness import SENTINEL, replay
    flush = {c: SENTINEL for c in ("monitor_id", "camera_id", "car", "road_id", "area_id")}
    # The sentinel must survive every filter of the query: Catalyst pushes
    # filters that do not reference the event-time column below the
    # watermark, so a filtered-out sentinel would never advance it.
    flush.update(speed=1e9, seq=-1)
    return replay(tb.passes(spark, d), "action_time", name, sentinel=flush, fmt=fmt)[1]


def _sentinel_dispatch(spark, d, name):
    from roadsight.streaming.harness import SENTINEL, replay
    v = replay(tb.violations(spark, d), "create_time", name + "-v",
               sentinel=dict(car=SENTINEL, violation=SENTINEL, out_count=0, seq=-1))[1]
    p = replay(tb.police_actions(spark, d), "action_time", name + "-p",
               sentinel=dict(car=SENTINEL, police_id=SENTINEL, action_status=SENTINEL, seq=-2))[1]
    return v, p


@register("stream_scan", W("passes") + f"SELECT {_TRAFFIC7} FROM passes")
def q_stream_scan(spark, d):
    from roadsight.sources.text import stream_traffic
    from roadsight.streaming.harness import replay, run_to_table
    src = tb.traffic_lines(spark, d).withColumn("_t", F.split("value", ",").getItem(0).cast("long"))
    path, _ = replay(src, "_t", "lines", slices=4, fmt="text")
    s = stream_traffic(spark, "text", path, "strict", maxFilesPerTrigger=spark.sparkContext.defaultParallelism)
    return run_to_table(s, "stream-scan")


@register("out_of_speed_stream", REGISTRY["out_of_speed"][1])
def q_out_of_speed_stream(spark, d):
    from roadsight.streaming.harness import run_to_table
    s = _sentinel_traffic(spark, d, "oos")
    return run_to_table(speed.out_of_speed(s, tb.limits(spark, d)), "out-of-speed")


@register("car_track_stream", REGISTRY["car_track"][1])
def q_car_track_stream(spark, d):
    from roadsight.operators.watchlist import keyed_tracks, listed_passes, to_track, with_row_key
    from roadsight.streaming.harness import run_to_table
    s = _sentinel_traffic(spark, d, "track")
    # append-only writes of keyed rows; the read side keeps the last write per key
    written = run_to_table(with_row_key(to_track(listed_passes(s, tb.watch_list(spark, d)))),
                           "car-track")
    return keyed_tracks(written.drop("row_key"))


@register("avg_speed_sliding_stream", AVG_SPEED_SQL)
def q_avg_speed_sliding_stream(spark, d):
    from roadsight.streaming.harness import SENTINEL, run_to_table
    from roadsight.streaming.twins import avg_speed_stream
    out = run_to_table(avg_speed_stream(_sentinel_traffic(spark, d, "avg")), "avg-speed")
    return out.filter(F.col("monitor_id") != SENTINEL)


@register("top3_free_flowing_stream", TOP3_SQL)
def q_top3_free_flowing_stream(spark, d):
    from roadsight.streaming.harness import SENTINEL, run_to_table
    from roadsight.streaming.twins import top_n_stream
    out = run_to_table(top_n_stream(_sentinel_traffic(spark, d, "top3"), 3), "top3")
    return out.filter(F.col("monitor_id") != SENTINEL)


@register("area_vehicle_count_stream", REGISTRY["area_vehicle_count"][1])
def q_area_vehicle_count_stream(spark, d):
    from roadsight.streaming.harness import SENTINEL, run_to_table
    from roadsight.streaming.twins import area_vehicles_stream
    s = _sentinel_traffic(spark, d, "area").drop("seq")
    out = run_to_table(area_vehicles_stream(s, "30 seconds"), "area-count")
    return out.filter(F.col("area_id") != SENTINEL)


@register("violation_action_interval_stream", INTERVAL_SQL)
def q_violation_action_interval_stream(spark, d):
    from roadsight.streaming.harness import not_sentinel, run_to_table
    from roadsight.streaming.twins import violation_action_interval_stream
    v, p = _sentinel_dispatch(spark, d, "interval")
    return not_sentinel(run_to_table(violation_action_interval_stream(v, p), "interval"))


@register("cloned_plate_stream", CLONED_SQL)
def q_cloned_plate_stream(spark, d):
    from roadsight.streaming.harness import not_sentinel, run_to_table
    from roadsight.streaming.twins import cloned_plate_stream
    s = _sentinel_traffic(spark, d, "clone")
    return not_sentinel(run_to_table(cloned_plate_stream(s), "cloned-plate", rocksdb=True))


@register("pair_violation_action_stream", PAIR_SQL)
def q_pair_violation_action_stream(spark, d):
    from roadsight.streaming.harness import not_sentinel, run_to_table
    from roadsight.streaming.twins import pair_violation_action_stream
    v, p = _sentinel_dispatch(spark, d, "pair")
    return not_sentinel(run_to_table(pair_violation_action_stream(v, p), "pairing", rocksdb=True))


@register("dangerous_car_longest_stream", _danger_sql(False))
def q_dangerous_car_longest_stream(spark, d):
    from roadsight.streaming.harness import not_sentinel, run_to_table
    from roadsight.streaming.twins import dangerous_car_stream
    s = _sentinel_traffic(spark, d, "danger")
    pw = speed.with_limit(s, tb.limits(spark, d), carry=["seq"])
    return not_sentinel(run_to_table(dangerous_car_stream(pw), "dangerous-car", rocksdb=True))


@register("dangerous_car_all_stream", _danger_sql(True))
def q_dangerous_car_all_stream(spark, d):
    from roadsight.streaming.harness import not_sentinel, run_to_table
    from roadsight.streaming.twins import dangerous_car_stream
    s = _sentinel_traffic(spark, d, "danger-all")
    pw = speed.with_limit(s, tb.limits(spark, d), carry=["seq"])
    return not_sentinel(run_to_table(dangerous_car_stream(pw, emit="all"), "dangerous-car-all", rocksdb=True))


@register("area_vehicle_running_stream", W("passes") + """
SELECT action_time - action_time % 30000 AS start_time,
       action_time - action_time % 30000 + 30000 AS end_time, area_id,
       cast(count(DISTINCT car) as integer) AS car_count
FROM passes GROUP BY 1, 2, 3""")
def q_area_vehicle_running_stream(spark, d):
    from roadsight.streaming.harness import SENTINEL, run_updates_to_table
    from roadsight.streaming.twins import area_vehicles_running_stream
    s = _sentinel_traffic(spark, d, "area-running").drop("seq")
    updates = run_updates_to_table(area_vehicles_running_stream(s, "30 seconds"), "area-running")
    # the change log's last update per (window, area) is the final count
    last = latest_by_key(updates, ["start_time", "end_time", "area_id"], "_batch")
    return last.drop("_batch").filter(F.col("area_id") != SENTINEL)


@register("violation_action_full_stream", REGISTRY["violation_action_full"][1])
def q_violation_action_full_stream(spark, d):
    from roadsight.streaming.harness import not_sentinel, run_to_table
    from roadsight.streaming.twins import classify_violation_action_stream
    v, p = _sentinel_dispatch(spark, d, "interval-full")
    return not_sentinel(run_to_table(classify_violation_action_stream(v, p), "interval-full"))


# Two loads of a dimension: the first holds half of the feed, the second some of the rest, so that
# keys change, are new, and vanish.  The stream is stopped and started anew between the two; the
# second load is due at the first batch after that.
_HALVES_SQL = """, halves AS (
  SELECT *, least((action_time - lo) // ((hi - lo + 1) // 2 + 1), 1) AS half
  FROM passes, (SELECT min(action_time) AS lo, max(action_time) AS hi FROM passes))"""


def _refreshed(spark, d, name, loads, key, start):
    """Replay the passes in two halves with a restart between; ``loads`` are the dimension's two loads."""
    from roadsight.session import scratch_dir
    from roadsight.streaming.batches import batch_folders
    from roadsight.streaming.dimensions import VersionedDimension
    from roadsight.streaming.harness import replay
    passes = tb.passes(spark, d)
    lo, hi = passes.agg(F.min("action_time"), F.max("action_time")).first()
    half = F.call_function("div", F.col("action_time") - F.lit(lo), F.lit((hi - lo + 1) // 2 + 1))
    root, path = scratch_dir(spark, name), None
    for i, load in enumerate(loads):
        path, stream = replay(passes.where(half == i), "action_time", name, slices=2, path=path)
        dim = VersionedDimension(spark, f"{root}/dimension", lambda load=load: load, key,
                                 refresh_seconds=3600, clock=lambda i=i: i * 3600.0)
        start(stream, dim, batch_folders(f"{root}/data"), f"{root}/checkpoint", availableNow=True).awaitTermination()
    return spark.read.parquet(f"{root}/data").drop("_batch_id")


@register("out_of_speed_refresh_stream", W("passes", "limits_feed") + _HALVES_SQL + """
, split AS (SELECT max(load_seq) // 2 AS m FROM limits_feed)
, one AS (SELECT monitor_id, speed_limit FROM (
    SELECT *, row_number() OVER (PARTITION BY monitor_id ORDER BY load_seq DESC) AS rn
    FROM limits_feed, split WHERE speed_limit > 0 AND load_seq <= m) WHERE rn = 1)
, two AS (SELECT monitor_id, speed_limit FROM (
    SELECT *, row_number() OVER (PARTITION BY monitor_id ORDER BY load_seq DESC) AS rn
    FROM limits_feed, split WHERE speed_limit > 0 AND load_seq > m AND load_seq % 3 = 0) WHERE rn = 1)
, versions AS (SELECT 0 AS half, * FROM one UNION ALL SELECT 1, * FROM two
               UNION ALL SELECT 1, * FROM one WHERE monitor_id NOT IN (SELECT monitor_id FROM two))
SELECT p.car, p.monitor_id, p.road_id, p.speed AS real_speed, l.speed_limit AS limit_speed, p.action_time
FROM halves p JOIN versions l ON p.monitor_id = l.monitor_id AND p.half = l.half
WHERE p.speed > l.speed_limit * 1.1e0""")
def q_out_of_speed_refresh_stream(spark, d):
    from roadsight.streaming.dimensions import out_of_speed_refreshed
    feed = tb.limits_feed(spark, d).where("speed_limit > 0")
    middle = tb.limits_feed(spark, d).agg(F.max("load_seq")).first()[0] // 2
    loads = [latest_by_key(rows, "monitor_id", "load_seq") for rows in (
        feed.where(F.col("load_seq") <= middle), feed.where((F.col("load_seq") > middle) & (F.col("load_seq") % 3 == 0)))]
    return _refreshed(spark, d, "speed-refresh", loads, "monitor_id", out_of_speed_refreshed)


@register("car_track_refresh_stream", W("passes", "watch_list") + _HALVES_SQL + f"""
SELECT {_ROW_KEY_SQL} AS row_key, {_TRACK} FROM halves
WHERE car IN (SELECT car FROM watch_list WHERE violation = '嫌疑套牌车')
   OR half = 1 AND car IN (SELECT car FROM watch_list WHERE violation LIKE '%9次')""")
def q_car_track_refresh_stream(spark, d):
    from roadsight.streaming.dimensions import track_listed_cars_refreshed
    watch = tb.watch_list(spark, d)
    loads = [watch.where("violation = '嫌疑套牌车'"), watch.where("violation LIKE '%9次'")]
    return _refreshed(spark, d, "track-refresh", loads, "car", track_listed_cars_refreshed).drop("seq")


@register("area_vehicle_running_records_stream", REGISTRY["area_vehicle_running"][1])
def q_area_vehicle_running_records_stream(spark, d):
    from roadsight.streaming.harness import SENTINEL, run_to_table
    from roadsight.streaming.twins import area_vehicles_running_records_stream
    s = _sentinel_traffic(spark, d, "area-records")
    out = run_to_table(area_vehicles_running_records_stream(s), "area-records")
    return out.filter(F.col("area_id") != SENTINEL)


@register("area_vehicle_bitmap_stream", REGISTRY["area_vehicle_bitmap"][1])
def q_area_vehicle_bitmap_stream(spark, d):
    """Counts read back from the bitmaps that the stream gathered."""
    from roadsight.operators.flow import bitmap_count
    from roadsight.streaming.harness import SENTINEL, run_to_table
    from roadsight.streaming.twins import area_vehicles_bitmap_stream
    s = _sentinel_traffic(spark, d, "area-bitmap").drop("seq")
    out = run_to_table(area_vehicles_bitmap_stream(s), "area-bitmap").filter(F.col("area_id") != SENTINEL)
    return out.withColumn("car_count", bitmap_count("bitmap").cast("int")).drop("bitmap")


@register("track_batches_stream", REGISTRY["track_batches"][1])
def q_track_batches_stream(spark, d):
    """Listed cars' tracks in write batches of 20 over the borders of micro-batches."""
    from roadsight.operators.watchlist import listed_passes, to_track, with_row_key
    from roadsight.session import scratch_dir
    from roadsight.streaming.batches import batch_folders, count_windows, run_batches
    from roadsight.streaming.harness import replay
    _, stream = replay(tb.passes(spark, d), "action_time", "track-batches")
    tracks = with_row_key(to_track(listed_passes(stream, tb.watch_list(spark, d))))
    root = scratch_dir(spark, "track-batches")
    body = count_windows(spark, root, 20, ["action_time", "seq"], batch_folders(f"{root}/data"))
    run_batches(tracks, body, f"{root}/checkpoint", availableNow=True).awaitTermination()
    return spark.read.parquet(f"{root}/data").drop("_batch_id", "seq")


# Passes that arrive out of order: up to 20 s after their own time.
_ARRIVED_SQL = W("passes") + ", arrived AS (SELECT *, (action_time + (seq * 7919) % 20000) * 1000000 + seq AS arrival FROM passes)"


def _arrived(spark, d):
    late = F.col("action_time") + (F.col("seq") * 7919) % 20000
    return tb.passes(spark, d).withColumn("arrival", late * 1_000_000 + F.col("seq"))


@register("late_rows", _ARRIVED_SQL + f"""
SELECT {_TRAFFIC7}, seq, arrival, seen AS max_seen_time FROM (
  SELECT *, max(action_time) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM arrived)
WHERE seen - 5000 > action_time""")
def q_late_rows(spark, d):
    from roadsight.streaming.twins import late_rows
    return late_rows(_arrived(spark, d), arrival="arrival", bucket=600_000 * 1_000_000)


@register("late_rows_stream", _ARRIVED_SQL + f"""
, sliced AS (SELECT *, (arrival - lo) // ((hi - lo + 1) // 6 + 1) AS slice
             FROM arrived, (SELECT min(arrival) AS lo, max(arrival) AS hi FROM arrived))
, marks AS (SELECT slice, max(max(action_time)) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 5000 AS mark
            FROM sliced GROUP BY slice)
SELECT {_TRAFFIC7}, seq, arrival, coalesce(action_time <= mark, false) AS late FROM sliced JOIN marks USING (slice)""")
def q_late_rows_stream(spark, d):
    """All rows of an out-of-order stream, from the two outputs of the split."""
    from roadsight.session import scratch_dir
    from roadsight.streaming.batches import batch_folders, run_batches, split_late
    from roadsight.streaming.harness import replay
    _, stream = replay(_arrived(spark, d), "arrival", "late")
    root = scratch_dir(spark, "late")
    body = split_late(spark, root, batch_folders(f"{root}/on_time"), batch_folders(f"{root}/late"))
    run_batches(stream, body, f"{root}/checkpoint", availableNow=True).awaitTermination()
    sides = [spark.read.parquet(f"{root}/{name}").drop("_batch_id").withColumn("late", F.lit(name == "late"))
             for name in ("on_time", "late")]
    return sides[0].unionByName(sides[1])


@register("area_vehicle_ingest_stream", _HALVES_SQL.replace(", halves", W("passes") + ", halves", 1) + """
, sliced AS (SELECT h.*, half * 2 + (action_time - a) // ((b - a + 1) // 2 + 1) AS batch
             FROM halves h JOIN (SELECT half, min(action_time) AS a, max(action_time) AS b FROM halves GROUP BY half) USING (half))
SELECT start_time, start_time + 30000 AS end_time, area_id, cast(count(DISTINCT car) AS integer) AS car_count
FROM (SELECT area_id, car, (1700000000000 + 20000 * batch) // 30000 * 30000 AS start_time FROM sliced) GROUP BY start_time, area_id""")
def q_area_vehicle_ingest_stream(spark, d):
    """Passes stamped as they arrive, 20 s a micro-batch by a given clock, with a restart on the way."""
    from roadsight.session import scratch_dir
    from roadsight.streaming.batches import run_batches, stamp_arrivals
    from roadsight.streaming.harness import SENTINEL, replay, run_to_table
    from roadsight.streaming.twins import area_vehicles_ingest_stream
    passes = tb.passes(spark, d)
    lo, hi = passes.agg(F.min("action_time"), F.max("action_time")).first()
    half = F.call_function("div", F.col("action_time") - F.lit(lo), F.lit((hi - lo + 1) // 2 + 1))
    root, path, ticks = scratch_dir(spark, "ingest"), None, iter(range(10))
    flush = {c: SENTINEL for c in ("monitor_id", "camera_id", "car", "road_id", "area_id")} | dict(speed=0.0, seq=-1)
    for i in (0, 1):
        path, stream = replay(passes.where(half == i), "action_time", "ingest", slices=2, path=path,
                              sentinel=flush if i else None)
        body = stamp_arrivals(spark, root, clock=lambda: 1_700_000_000 + 20 * next(ticks))
        run_batches(stream, body, f"{root}/checkpoint", availableNow=True).awaitTermination()
    stored = spark.read.parquet(f"{root}/data")
    flushed = stored.where(F.col("car") == SENTINEL).withColumn("arrival_time", F.col("arrival_time") + 86_400_000)
    flushed.drop("_batch_id").write.parquet(f"{root}/data/_batch_id=99")   # closes the last window
    stamped = spark.readStream.schema(stored.schema).parquet(f"{root}/data")
    out = run_to_table(area_vehicles_ingest_stream(stamped), "ingest")
    return out.filter(F.col("area_id") != SENTINEL)
