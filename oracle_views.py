"""SQL views over the benchmark tables that the oracle queries are built from."""

from __future__ import annotations

STEP = "INTERVAL 1 DAY"

VIEWS: dict[str, str] = {
    "telemetry": """
        SELECT event_id, ts AS time, concat('h', user_id) AS agent_host,
               CASE event_type WHEN 'view' THEN 'rx_primary' WHEN 'click' THEN 'rx_fallback'
                               WHEN 'purchase' THEN 'tx_primary' WHEN 'signup' THEN 'tx_fallback'
                               ELSE 'temperature' END AS field,
               CASE WHEN event_type IN ('view','click')
                      THEN CASE WHEN event_id % 97 = 0 THEN 0.0 ELSE -(30 + event_id % 45 + value/1000) END
                    WHEN event_type IN ('purchase','signup') THEN 5 + event_id % 37 + value/1000
                    ELSE 10 + event_id % 25 + value/1000 END AS value
        FROM events""",
    "sites": """
        SELECT s_suppkey AS id, s_name AS address, CAST(11.5 + 0.05*(s_suppkey % 150) AS DOUBLE) AS lon,
               CAST(48.2 + 0.05*(CAST(floor(s_suppkey/150) AS BIGINT) % 60) AS DOUBLE) AS lat,
               s_nationkey AS technology
        FROM supplier""",
    "links_all": """
        SELECT a.id AS cml_id, concat(a.address, ' <-> ', b.address) AS name,
               CASE r_regionkey WHEN 0 THEN 'summit' WHEN 1 THEN 'summit_bt' ELSE r_name END AS tech,
               7000 + 1000*(a.id % 74) AS freq_a,
               7000 + 1000*(a.id % 74) + CASE WHEN a.id % 5 = 0 THEN 0 ELSE 500 END AS freq_b,
               CASE a.id % 3 WHEN 0 THEN 'H' ELSE 'V' END AS polarization,
               concat('h', 2*a.id) AS ip_a, concat('h', 2*a.id + 1) AS ip_b,
               a.lat AS lat_a, a.lon AS lon_a, b.lat AS lat_b, b.lon AS lon_b,
               pow(sin((radians(b.lat)-radians(a.lat))/2),2)
                 + cos(radians(a.lat))*cos(radians(b.lat))*pow(sin((radians(b.lon)-radians(a.lon))/2),2) AS h
        FROM sites a JOIN sites b ON b.id = (a.id + 1) % (SELECT count(*) FROM sites)
        JOIN nation ON a.technology = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "links": """
        SELECT * FROM (SELECT *, 2*6373.0*atan2(sqrt(h), sqrt(1-h)) AS length FROM links_all)
        WHERE length BETWEEN 0.5 AND 100 AND cml_id % 13 <> 0""",
    "wide": """
        SELECT agent_host, date_trunc('day', time) + INTERVAL 1 DAY AS time,
               coalesce(avg(value) FILTER (WHERE field='rx_primary'), avg(value) FILTER (WHERE field='rx_fallback')) AS rx_power,
               coalesce(avg(value) FILTER (WHERE field='tx_primary'), avg(value) FILTER (WHERE field='tx_fallback')) AS tx_power,
               avg(value) FILTER (WHERE field='temperature') AS temperature
        FROM telemetry GROUP BY 1, 2""",
    "link_dims": """
        SELECT *, CASE WHEN freq_a = freq_b THEN freq_a + 1 ELSE freq_a END / 1000.0 AS f_ba, freq_b / 1000.0 AS f_ab,
               CASE WHEN tech IN ('summit','summit_bt') THEN -1.0 ELSE 1.0 END AS sgn FROM links""",
    "paired": """
        SELECT cml_id, w.time,
               max(CASE WHEN side='a' THEN 1 END) AS has_a, max(CASE WHEN side='b' THEN 1 END) AS has_b,
               max(CASE WHEN side='a' THEN rx_power END) AS a_rx, max(CASE WHEN side='b' THEN rx_power END) AS b_rx,
               max(CASE WHEN side='a' THEN tx_power END) AS a_tx, max(CASE WHEN side='b' THEN tx_power END) AS b_tx,
               max(CASE WHEN side='a' THEN temperature END) AS a_t, max(CASE WHEN side='b' THEN temperature END) AS b_t
        FROM (SELECT cml_id, 'a' AS side, ip_a AS host FROM links UNION ALL SELECT cml_id, 'b', ip_b FROM links) e
        JOIN wide w ON w.agent_host = e.host GROUP BY 1, 2""",
    "paired_ok": """
        SELECT * FROM paired WHERE cml_id IN (SELECT cml_id FROM paired GROUP BY 1 HAVING max(has_a) = 1 AND max(has_b) = 1)""",
    "channels": """
        SELECT p.cml_id, 'A(rx)_B(tx)' AS channel_id, time,
               CASE WHEN has_a = 1 THEN coalesce(b_tx, 0.0) END AS tsl, sgn*a_rx AS rsl,
               CASE WHEN has_a = 1 THEN coalesce(a_t, 0.0) END AS temperature_rx,
               CASE WHEN has_a = 1 THEN coalesce(b_t, 0.0) END AS temperature_tx,
               f_ab AS frequency, polarization, length
        FROM paired_ok p JOIN link_dims USING (cml_id)
        UNION ALL
        SELECT p.cml_id, 'B(rx)_A(tx)', time,
               CASE WHEN has_b = 1 THEN coalesce(a_tx, 0.0) END, sgn*b_rx,
               CASE WHEN has_b = 1 THEN coalesce(b_t, 0.0) END,
               CASE WHEN has_b = 1 THEN coalesce(a_t, 0.0) END,
               f_ba, polarization, length
        FROM paired_ok p JOIN link_dims USING (cml_id)""",
    "valid": """
        SELECT * REPLACE (CASE WHEN tsl < 40 THEN tsl END AS tsl, CASE WHEN rsl <> 0 AND rsl > -70 THEN rsl END AS rsl),
               epoch(time) AS s FROM channels""",
}


def _filled(column: str, kind: str) -> str:
    p_v, p_s = f"{column}_pv", f"{column}_ps"
    n_v, n_s = f"{column}_nv", f"{column}_ns"
    value = (
        f"CASE WHEN s - {p_s} <= {n_s} - s THEN {p_v} ELSE {n_v} END"
        if kind == "nearest"
        else f"{p_v} + ({n_v} - {p_v}) * (s - {p_s}) / ({n_s} - {p_s})"
    )
    return (
        f"CASE WHEN {column} IS NOT NULL THEN {column} "
        f"WHEN {p_v} IS NOT NULL AND {n_v} IS NOT NULL THEN {value} END AS {column}"
    )


def _neighbours(column: str) -> str:
    known = f"CASE WHEN {column} IS NOT NULL THEN s END"
    return (
        f"last_value({column} IGNORE NULLS) OVER back AS {column}_pv, last_value({known} IGNORE NULLS) OVER back AS {column}_ps, "
        f"first_value({column} IGNORE NULLS) OVER ahead AS {column}_nv, first_value({known} IGNORE NULLS) OVER ahead AS {column}_ns"
    )


_FILL = {"tsl": "nearest", "rsl": "nearest", "temperature_rx": "linear", "temperature_tx": "linear"}
VIEWS["known"] = f"""
        SELECT *, {", ".join(_neighbours(c) for c in _FILL)} FROM valid
        WINDOW back AS (PARTITION BY cml_id, channel_id ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               ahead AS (PARTITION BY cml_id, channel_id ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""
VIEWS["filled"] = f"""
        SELECT cml_id, channel_id, time, s, frequency, polarization, length,
               {", ".join(_filled(c, k) for c, k in _FILL.items())} FROM known"""
VIEWS["clean"] = "SELECT *, tsl - rsl AS trsl FROM filled"

# Window length and threshold that split the derived series into wet and dry.
ROLL, THRESHOLD = 3, 10.0


def _rolling(frame: str) -> str:
    return f"""
        SELECT *, CASE WHEN count(trsl) OVER w = {ROLL} THEN stddev_pop(trsl) OVER w > {THRESHOLD} ELSE FALSE END AS wet
        FROM clean WINDOW w AS (PARTITION BY cml_id, channel_id ORDER BY time ROWS BETWEEN {frame})"""


VIEWS["wet"] = _rolling(f"{ROLL - 1} PRECEDING AND CURRENT ROW")
VIEWS["wet_centered"] = _rolling(f"{ROLL // 2} PRECEDING AND {(ROLL - 1) // 2} FOLLOWING")
VIEWS["numbered"] = """
        SELECT *, row_number() OVER (PARTITION BY cml_id, channel_id ORDER BY time) AS rn FROM wet"""
VIEWS["anchored"] = """
        SELECT *, max(CASE WHEN rn = 1 OR NOT wet THEN rn END) OVER (
               PARTITION BY cml_id, channel_id ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS anchor
        FROM numbered"""
VIEWS["based"] = """
        SELECT a.*, b.trsl AS baseline FROM anchored a JOIN numbered b
          ON a.cml_id = b.cml_id AND a.channel_id = b.channel_id AND a.anchor = b.rn"""


# Three samples averaged before each wet period; the wet-antenna loss climbs half of the rest per step.
_BASE = ("CASE WHEN n.rn <= 3 THEN n.trsl WHEN n.wet AND NOT w.wet THEN CASE WHEN list_count(w.hist) = 3 THEN list_avg(w.hist) END "
         "WHEN n.wet THEN w.baseline ELSE n.trsl END")
VIEWS["walked"] = f"""
        SELECT cml_id, channel_id, time, rn, trsl, wet, trsl AS baseline, [trsl] AS hist, trsl - trsl AS waa
        FROM numbered WHERE rn = 1
        UNION ALL
        SELECT cml_id, channel_id, time, rn, trsl, wet, base, list_append(hist, base)[greatest(len(hist) - 1, 1):],
               CASE WHEN trsl - base IS NULL THEN NULL WHEN wet THEN least(trsl - base, 2.2, waa + (2.2 - waa)*0.5)
                    ELSE least(trsl - base, 2.2) END
        FROM (SELECT n.*, w.hist, w.waa, {_BASE} AS base FROM walked w
              JOIN numbered n ON n.cml_id = w.cml_id AND n.channel_id = w.channel_id AND n.rn = w.rn + 1)"""


def _itu(terms, m: float, q: float) -> str:
    bells = " + ".join(f"({a})*exp(-pow((lf-({b}))/({c}),2))" for a, b, c in terms)
    return f"({bells} + ({m})*lf + ({q}))"


def _itu_columns() -> str:
    from pluvio.functions.rainrate import ITU_ALPHA, ITU_K

    return (
        f"CASE WHEN polarization='H' THEN pow(10, {_itu(*ITU_K['H'])}) ELSE pow(10, {_itu(*ITU_K['V'])}) END AS k, "
        f"CASE WHEN polarization='H' THEN {_itu(*ITU_ALPHA['H'])} ELSE {_itu(*ITU_ALPHA['V'])} END AS alpha"
    )


VIEWS["attenuated"] = f"""
        SELECT *, {_itu_columns()}, CASE WHEN trsl - baseline >= 0 THEN trsl - baseline ELSE 0.0 END AS a_rain
        FROM (SELECT *, log10(frequency) AS lf FROM based)"""
VIEWS["attenuated_walk"] = f"""
        SELECT w.*, d.k, d.alpha, d.length, CASE WHEN w.trsl - w.baseline >= 0 THEN w.trsl - w.baseline ELSE 0.0 END AS a_rain
        FROM walked w JOIN (SELECT DISTINCT cml_id, channel_id, k, alpha, length FROM attenuated) d
          ON d.cml_id = w.cml_id AND d.channel_id = w.channel_id"""
VIEWS["rain_walk"] = """
        SELECT *, CASE WHEN pow(a/(k*length), 1/alpha) < 0.1 THEN 0.0 ELSE pow(a/(k*length), 1/alpha) END AS r
        FROM (SELECT *, CASE WHEN a_rain - waa >= 0 THEN a_rain - waa ELSE 0.0 END AS a FROM attenuated_walk)"""
VIEWS["rain"] = """
        SELECT *, CASE WHEN pow(a_rain/(k*length), 1/alpha) < 0.1 THEN 0.0 ELSE pow(a_rain/(k*length), 1/alpha) END AS r
        FROM attenuated"""
VIEWS["link_rain"] = "SELECT cml_id, time, avg(r) AS r FROM rain GROUP BY 1, 2"
VIEWS["axis"] = """
        SELECT time, row_number() OVER (ORDER BY time) - 1 AS pos FROM (SELECT DISTINCT time FROM link_rain)"""
VIEWS["aligned"] = """
        SELECT l.cml_id, x.time, x.pos, r.r FROM (SELECT DISTINCT cml_id FROM link_rain) l CROSS JOIN axis x
        LEFT JOIN link_rain r ON r.cml_id = l.cml_id AND r.time = x.time"""
# Daily steps, sums over three of them.
VIEWS["hour_sum"] = """
        SELECT *, CASE WHEN pos >= 2 THEN coalesce(sum(r * 24.0) OVER (
               PARTITION BY cml_id ORDER BY pos ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 0.0) END AS r_hour_sum
        FROM aligned"""
VIEWS["series"] = """
        SELECT l_suppkey AS cml_id, l_shipdate AS time, avg(l_quantity) AS x, avg(l_extendedprice/1000) AS y,
               avg(l_tax*100) AS temp, greatest(min(l_discount)*100e0 - 5, 0e0) AS rain, max(l_orderkey) AS uptime
        FROM lineitem GROUP BY 1, 2"""


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """The query with the views it needs in front of it."""
    import re

    views = {**VIEWS, **(extra or {})}
    needed: list[str] = []
    entered: set[str] = set()  # a recursive view names itself

    def visit(text: str) -> None:
        for word in re.findall(r"[a-z_0-9]+", text):
            if word in views and word not in entered and _is_table(word, text):
                entered.add(word)
                visit(views[word])
                needed.append(word)

    def _is_table(word: str, text: str) -> bool:
        return re.search(rf"\b(?:FROM|JOIN)\s+{word}\b", text) is not None

    visit(body)
    if not needed:
        return body
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({views[n]})" for n in needed) + "\n" + body


def r(expr: str, digits: int = 6) -> str:
    """Rounding written out, with the boundary moved off the decimal ties."""
    scale = f"1e{digits}"
    return f"floor(({expr})*{scale}+0.4997)/{scale}"


def ts(expr: str = "time") -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"
