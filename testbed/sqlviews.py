"""The domain views of ``tables`` as DuckDB common table expressions, and SQL fragments."""

from __future__ import annotations

# Numbers of the projection, written out: WGS84 and the meridian arc in latitude, sin, sin^3, sin^5.
DEGREE = 0.017453292519943334
SEMI_MAJOR = 6378137.0
E2 = 0.0066943799901413165
EP2 = 0.006739496742276434
ARC_LAT = 6367449.145823035
ARC_SIN1 = -32009.818962023488
ARC_SIN3 = -133.9564292830688
ARC_SIN5 = -0.7044756343191493

ECI = "(CAST(25600 AS BIGINT) + (k//4)*256 + k%4)"
CELL = f"(CASE WHEN k%5=0 THEN concat_ws('_', k, k%4) ELSE CAST({ECI} AS VARCHAR) END)"
CODE = f"CAST(CASE WHEN k%5=0 THEN CAST(k AS BIGINT)*100000 + k%4 ELSE {ECI} END AS VARCHAR)"
LON = "(105e0 + (k%10)*2e-2)"
LAT = "(265e-1 + ((k//10)%100)*2e-2)"
RAT = "(CASE WHEN k%5=0 THEN 2 ELSE 6 END)"
INDOOR = "(CASE WHEN value>=20 THEN 'INDOOR' ELSE 'ROAD' END)"
MS = "CAST(floor(value*6e5) AS BIGINT)"


def _intervals(code: str) -> str:
    return f"""(SELECT imsi, date, event_id, {code} AS code, s_time, s_time + {MS} AS e_time,
  {MS} AS duration, {LON} AS lon, {LAT} AS lat, {INDOOR} AS scene, {RAT} AS rat FROM ev)"""


def _place(k: str) -> dict[str, str]:
    return {
        "aoi": f"concat('C', ({k})%10)",
        "grid": f"concat('C', (({k})+3)%10)",
        "sector": f"CAST(25600 + (({k})//4)*256 + ({k})%4 AS VARCHAR)",
    }


_HOME, _WORK, _HOL = "c_custkey%100", "(c_custkey*7+8)%100", "(c_custkey*11+10)%100"
_PLACES = ", ".join(
    f"{expr} AS {side}_{kind}"
    for side, k in (("live", _HOME), ("work", _WORK))
    for kind, expr in _place(k).items()
)

VIEWS = f"""WITH ev AS (
  SELECT CAST(user_id AS VARCHAR) AS imsi, strftime(ts, '%Y-%m-%d') AS date, event_id,
    epoch_us(ts)//1000 AS s_time, event_type, value,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
  FROM events),
pt0 AS (
  SELECT *, CASE event_type WHEN 'view' THEN '5' WHEN 'click' THEN '6' WHEN 'purchase' THEN '2'
      WHEN 'signup' THEN '7' WHEN 'error' THEN '8' END AS loc_type,
    {CELL} AS cell, {ECI} AS eci, {LON} + value*1.1371859e-5 AS lon, {LAT} + value*4.7131859e-6 AS lat,
    {INDOOR} AS scene FROM ev),
pt AS (
  SELECT * EXCLUDE (event_type),
    CASE WHEN loc_type='2' THEN 'MDT' WHEN loc_type IN ('5','6') THEN 'MR' ELSE 'XDR' END AS source,
    {RAT} AS rat, {CODE} AS code FROM pt0),
iv AS {_intervals(CODE)},
iv_eci AS {_intervals(f"CAST({ECI} AS VARCHAR)")},
iv_county AS {_intervals("concat('C', k//10)")},
iv_city AS {_intervals("concat('T', k//25)")},
cells AS (
  SELECT k, {ECI} AS eci, {CELL} AS cell, {RAT} AS rat, {CODE} AS code,
    CASE k%10 WHEN 0 THEN 'YDY3' WHEN 1 THEN 'YDY2' WHEN 2 THEN 'YDY9' WHEN 3 THEN 'YDY9'
      WHEN 4 THEN 'YDY9' ELSE 'YDY0' END AS scene_id,
    CASE k%10 WHEN 0 THEN '高铁站' WHEN 1 THEN '飞机场' WHEN 2 THEN '学校' WHEN 3 THEN '医院'
      WHEN 4 THEN '商务区' ELSE '其他' END AS scene_name,
    concat('C', k//10) AS county_id, concat('county ', k//10) AS county_name,
    concat('T', k//25) AS city_id, concat('city ', k//25) AS city_name,
    concat('P', k//50) AS province_id, {LON} AS lon, {LAT} AS lat
  FROM (SELECT p_partkey AS k FROM part)),
subs AS (
  SELECT CAST(c_custkey AS VARCHAR) AS imsi, concat('138', c_custkey) AS phone,
    concat('86', c_custkey) AS imei, CAST(18 + c_custkey%50 AS INTEGER) AS age,
    c_acctbal AS income, CASE WHEN c_custkey%2=0 THEN 'Male' ELSE 'Female' END AS gender,
    CASE WHEN c_custkey%3=0 THEN 'G5' ELSE 'G4' END AS network, {_PLACES},
    {_place(_HOME)["sector"]} AS home_cell, {_place(_WORK)["sector"]} AS work_cell,
    {_place(_HOL)["sector"]} AS holiday_cell
  FROM customer),
tick AS (
  SELECT o_orderkey AS event_id, CAST(o_custkey AS VARCHAR) AS imsi,
    concat('138', o_custkey) AS phone, concat('R', o_orderkey%7) AS city_code,
    concat('D', o_orderkey%11) AS county_code, o_orderkey%50000 + 4096 AS lac,
    (o_orderkey*37)%100000 AS ci, strftime(DATE '2024-01-01' + CAST(o_orderkey%30 AS INTEGER), '%Y%m%d103000') AS start_text,
    1704067200000 + (o_orderkey%30)*86400000 + 37800000 AS s_time,
    CAST(floor(o_totalprice/100) AS BIGINT) AS seconds,
    CASE WHEN o_orderkey%2=0 THEN 'voice' ELSE 'data' END AS service,
    CASE WHEN o_orderkey%4<2 THEN 'local' ELSE 'out' END AS origin
  FROM orders),
roam0 AS (
  SELECT concat('138', imsi) AS phone, min(event_id) AS event_id, date, min(s_time) AS s_time,
    max(s_time) AS e_time, arg_max(k, (s_time, event_id)) AS k FROM ev GROUP BY imsi, date),
roam AS (
  SELECT * EXCLUDE (k), CASE WHEN k%4=0 THEN '66' ELSE '86' END AS country_code,
    CASE WHEN k%4=0 THEN '泰国' ELSE '中国' END AS country_name,
    CASE WHEN k%4=0 THEN 'Thailand' ELSE 'China' END AS country_name_en,
    CASE WHEN k%7=0 THEN '' ELSE concat('P', k//10) END AS province_code,
    CASE WHEN k%7=0 THEN '' ELSE concat('province ', k//10) END AS province_name,
    'P0' AS home_province_code, 'province 0' AS home_province_name FROM roam0),
sig AS (
  SELECT concat('P', k%10) AS home_province, imsi,
    concat(CASE WHEN CAST(imsi AS BIGINT)%4=0 THEN '66' ELSE '86' END, '138', imsi) AS msisdn, event_id,
    date, s_time, CAST({ECI} AS VARCHAR) AS cell, {LON} AS lon, {LAT} AS lat,
    strftime(epoch_ms(s_time), '%Y%m%d%H') AS stat_hour FROM ev)"""

KEYS = "imsi, date"
MIDNIGHT = "(epoch_us(CAST(date AS TIMESTAMP))//1000)"


def project(source: str, lon: str = "lon", lat: str = "lat", x: str = "x", y: str = "y") -> str:
    """``source`` with projected metres, written out term by term."""
    d, a = repr(DEGREE), repr(SEMI_MAJOR)
    e2, ep2 = repr(E2), repr(EP2)
    arc = f"({ARC_LAT!r}*_b + cos(_b)*({ARC_SIN1!r}*sin(_b)"
    arc += f" + {ARC_SIN3!r}*pow(sin(_b),3) + {ARC_SIN5!r}*pow(sin(_b),5)))"
    east = "_n*_m + (1-_t*_t+_q)*_n*pow(_m,3)/6"
    east += " + (5-18*_t*_t+pow(_t,4)-14*_q-58*_q*_t*_t)*_n*pow(_m,5)/120"
    north = "_n*_t*_m*_m/2 + (5-_t*_t+9*_q+4*_q*_q)*_n*_t*pow(_m,4)/24"
    north += " + (61-58*_t*_t+pow(_t,4))*_n*_t*pow(_m,6)/720"
    d, a, e2, ep2 = (f"CAST('{v}' AS DOUBLE)" for v in (d, a, e2, ep2))
    return f"""(SELECT * EXCLUDE (_b,_t,_m,_n,_q), {east} + 5e5 AS {x}, {arc} + {north} AS {y}
 FROM (SELECT *, tan(_b) AS _t, ({lon}*{d} - 105*{d})*cos(_b) AS _m,
   {a}/sqrt(1-{e2}*sin(_b)*sin(_b)) AS _n, {ep2}*cos(_b)*cos(_b) AS _q
   FROM (SELECT *, {lat}*{d} AS _b FROM {source})))"""


def unproject(source: str, x: str = "x", y: str = "y", lon: str = "lon", lat: str = "lat") -> str:
    """``source`` with degrees of projected metres."""
    e2 = E2
    r = (1 - (1 - e2) ** 0.5) / (1 + (1 - e2) ** 0.5)
    quad = SEMI_MAJOR * (1 - e2 / 4 - 3 * e2 * e2 / 64 - 5 * e2**3 / 256)

    def v(number: float) -> str:
        return f"CAST('{number!r}' AS DOUBLE)"

    foot = (
        f"_u + {v(3*r/2 - 27*r**3/32)}*sin(2*_u) + {v(21*r*r/16 - 55*r**4/32)}*sin(4*_u)"
        f" + {v(151*r**3/96)}*sin(6*_u) + {v(1097*r**4/512)}*sin(8*_u)"
    )
    e, ep, d = v(e2), v(EP2), v(DEGREE)
    a = v(SEMI_MAJOR)
    lon_expr = (
        "_d - (1+2*_t+_c)*pow(_d,3)/6 + "
        f"(5-2*_c+28*_t-3*_c*_c+8*{ep}+24*_t*_t)*pow(_d,5)/120"
    )
    lat_expr = (
        f"_d*_d/2 - (5+3*_t+10*_c-4*_c*_c-9*{ep})*pow(_d,4)/24 + "
        f"(61+90*_t+298*_c+45*_t*_t-256*{ep}-3*_c*_c)*pow(_d,6)/720"
    )
    return f"""(SELECT * EXCLUDE (_u,_f,_c,_t,_n,_r,_d),
   105 + ({lon_expr})/cos(_f)/{d} AS {lon}, (_f - _n*tan(_f)/_r*({lat_expr}))/{d} AS {lat}
 FROM (SELECT *, ({x} - 5e5)/_n AS _d FROM (SELECT *, {ep}*cos(_f)*cos(_f) AS _c,
   tan(_f)*tan(_f) AS _t, {a}/sqrt(1-{e}*sin(_f)*sin(_f)) AS _n,
   {a}*(1-{e})/pow(sqrt(1-{e}*sin(_f)*sin(_f)),3) AS _r
   FROM (SELECT *, {foot} AS _f FROM (SELECT *, {y}/{v(quad)} AS _u FROM {source})))))"""


def runs(source: str, code: str = "code", keys: str = KEYS, order: str = "s_time, event_id") -> str:
    """``source`` with run number ``g`` of equal codes."""
    return f"""(SELECT * EXCLUDE (_ch), sum(_ch) OVER (PARTITION BY {keys} ORDER BY {order}
   ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN {code} IS NOT DISTINCT FROM
   lag({code}) OVER (PARTITION BY {keys} ORDER BY {order}) THEN 0 ELSE 1 END AS _ch
   FROM {source}))"""


def smooth(source: str, keys: str = KEYS, order: str = "s_time, event_id") -> str:
    return f"""(SELECT * REPLACE (least(e_time, coalesce(lead(s_time) OVER
   (PARTITION BY {keys} ORDER BY {order}), e_time)) AS e_time) FROM {source})"""


def merge(
    source: str,
    keys: str = KEYS,
    order: str = "s_time, event_id",
    carry: tuple[str, ...] = (),
    midpoint: bool = True,
) -> str:
    """Neighbouring stays with one code merged."""
    first = "".join(f", arg_min({c}, ({order})) AS {c}" for c in ("event_id", "rat", *carry))
    if midpoint:
        src = runs(project(source, x="_x", y="_y"), keys=keys, order=order)
        mid = f""", list_reduce(list(_x ORDER BY {order}) FILTER (_x IS NOT NULL), lambda p, q: (p+q)/2) AS _mx,
     list_reduce(list(_y ORDER BY {order}) FILTER (_y IS NOT NULL), lambda p, q: (p+q)/2) AS _my"""
    else:
        src, mid = runs(source, keys=keys, order=order), ""
    grouped = f"""(SELECT {keys}, code{first}, min(s_time) AS s_time, max(e_time) AS e_time,
     max(e_time) - min(s_time) AS duration, count(*) AS _cnt,
     arg_min(lon, ({order})) AS _lon, arg_min(lat, ({order})) AS _lat,
     CASE WHEN bool_or(scene='INDOOR') THEN 'INDOOR' ELSE arg_max(scene, ({order})) END AS scene{mid}
   FROM {src} GROUP BY {keys}, code, g)"""
    if not midpoint:
        return f"(SELECT * EXCLUDE (_cnt,_lon,_lat), _lon AS lon, _lat AS lat FROM {grouped})"
    out = unproject(grouped, "_mx", "_my", "_ulon", "_ulat")
    return f"""(SELECT * EXCLUDE (_cnt,_lon,_lat,_mx,_my,_ulon,_ulat),
   CASE WHEN _cnt=1 THEN _lon ELSE _ulon END AS lon, CASE WHEN _cnt=1 THEN _lat ELSE _ulat END AS lat
   FROM {out})"""


def aggregate(source: str, carry: str = "", keys: str = KEYS) -> str:
    """Stays of points: the twin of ``stay_aggregate``."""
    o = "(s_time, event_id)"
    sources = """concat('|', list_reduce(list_prepend('', list(source ORDER BY s_time, event_id)),
       lambda a, b: CASE WHEN contains(a, b) THEN a ELSE concat(a, b) END))"""
    grouped = f"""(SELECT {keys}, code, arg_min(event_id, {o}) AS event_id,
     min(s_time) AS s_time, max(s_time) AS e_time, max(s_time) - min(s_time) AS duration,
     count(*) AS points, avg(_x) AS _x, avg(_y) AS _y, arg_min(rat, {o}) AS rat,
     CASE WHEN bool_or(scene='INDOOR') THEN 'INDOOR' ELSE arg_max(scene, {o}) END AS scene,
     {sources} AS source{carry}
   FROM {runs(project(source, x="_x", y="_y"), keys=keys)} GROUP BY {keys}, code, g)"""
    out = unproject(grouped, "_x", "_y")
    return f"(SELECT * EXCLUDE (_x, _y) FROM {out})"


TRACE = f", tr AS (SELECT * FROM {merge(smooth('iv_county'), midpoint=False)})"
