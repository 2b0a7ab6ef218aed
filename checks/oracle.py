"""DuckDB SQL giving the expected result of each query in ``queries.py``.

Named subqueries are shared; ``sql`` puts those a statement needs into its
``WITH`` list.
"""

from __future__ import annotations

import re

from checks.standins import CITIES, DIMS, PERIOD, SETTINGS, WINDOW
from quartergrid.config import POI_FIELDS
from quartergrid.functions.geohash import BASE32

TOTAL = WINDOW.total_steps
LOOKBACK = SETTINGS.lookback

# Written out here, so that an order the engine gets wrong shows.
TRAFFIC_COLUMNS = (
    "t_accident", "t_broken_vehicle", "t_congestion", "t_construction", "t_event", "t_flow_incident",
    "t_other", "t_road_blocked",
)
WEATHER_MEASURES = ("humidity", "precipitation", "pressure", "temperature", "visibility", "wind_speed")
WEATHER_COLUMNS = (
    "w_humidity", "w_precipitation", "w_pressure", "w_temperature", "w_visibility", "w_wind_speed",
)
FLAG_COLUMNS = ("w_rain", "w_snow", "w_fog", "w_hail")
HOUR_COLUMNS = ("hod_en0", "hod_en1", "hod_en2", "hod_en3", "hod_en4")
SCALED_COLUMNS = (
    "t_broken_vehicle", "t_congestion", "t_construction", "t_event", "t_flow_incident", "t_other",
    "t_road_blocked", "w_humidity", "w_precipitation", "w_pressure", "w_temperature", "w_visibility",
    "w_wind_speed", "w_rain", "w_snow", "w_fog", "w_hail",
)
STEP_FEATURES = (
    "dow_cat", "t_accident", "daylight", "t_broken_vehicle", "t_congestion", "t_construction", "t_event",
    "t_flow_incident", "t_other", "t_road_blocked", "w_humidity", "w_precipitation", "w_pressure",
    "w_temperature", "w_visibility", "w_wind_speed", "w_rain", "w_snow", "w_fog", "w_hail",
    "hod_en0", "hod_en1", "hod_en2", "hod_en3", "hod_en4",
)
RAW_GRID_COLUMNS = (
    "cell", "step", "dow", "hod", "daylight", "t_accident", "t_broken_vehicle", "t_congestion",
    "t_construction", "t_event", "t_flow_incident", "t_other", "t_road_blocked", "w_humidity",
    "w_precipitation", "w_pressure", "w_temperature", "w_visibility", "w_wind_speed", "w_rain", "w_snow",
    "w_fog", "w_hail",
)


def comma(items) -> str:
    return ", ".join(items)


def r6(expr: str, name: str) -> str:
    return f"round({expr}, 6) + 0.0 AS {name}"


def _cell() -> str:
    letters = []
    for letter in range(5):
        terms = []
        for position in range(5):
            bit = 5 * letter + position
            source, bits = ("gx", 13) if bit % 2 == 0 else ("gy", 12)
            terms.append(f"(({source} >> {bits - 1 - bit // 2}) & 1) * {1 << (4 - position)}")
        letters.append(f"substr('{BASE32}', ({' + '.join(terms)}) + 1, 1)")
    return " || ".join(letters)


def _lattice(cell: str, want: str) -> str:
    lng = want == "x"
    terms = []
    for bit in range(25):
        if (bit % 2 == 0) == lng:
            code = f"(instr('{BASE32}', substr({cell}, {bit // 5 + 1}, 1)) - 1)"
            bits = 13 if lng else 12
            terms.append(f"(({code} >> {4 - bit % 5}) & 1) * {1 << (bits - 1 - bit // 2)}")
    return " + ".join(terms)


def _step(local: str) -> str:
    return (
        f"CASE WHEN {local} IS NULL THEN NULL "
        f"WHEN {local} < TIMESTAMP '{WINDOW.begin_text}' OR {local} > TIMESTAMP '{WINDOW.end_text}' "
        f"THEN -1 ELSE (epoch_us({local}) - epoch_us(TIMESTAMP '{WINDOW.begin_text}')) "
        f"// 900000000 END"
    )


def _base(a: float, b: float, c: float) -> str:
    return (
        f"CASE WHEN user_id % 10 = 9 THEN 0.0::DOUBLE WHEN user_id % 3 = 0 THEN {a}::DOUBLE "
        f"WHEN user_id % 3 = 1 THEN {b}::DOUBLE ELSE {c}::DOUBLE END"
    )


def _flag(words: list[list[str]], tag: str) -> str:
    def any_of(group):
        return "(" + " OR ".join(f"contains(lower({tag}), '{w}')" for w in group) + ")"
    *before, last = words
    tests = [f"NOT {any_of(g)}" for g in before] + [any_of(last)]
    return f"coalesce({' AND '.join(tests)}, false)"


_WORDS = [["rain", "drizzle", "thunderstorm"], ["snow"], ["fog", "haze", "mist", "smoke"],
          ["hail", "ice pellets"]]
_MEASURE = {
    "temperature": (9, "value"), "humidity": (8, "value / 2"), "pressure": (10, "value + 900"),
    "visibility": (11, "value / 5"), "wind_speed": (12, "value * 2"),
    "precipitation": (7, "value / 10"),
}
_CLASSES = {
    "t_accident": "Accident", "t_broken_vehicle": "BrokenVehicle", "t_congestion": "Congestion",
    "t_construction": "Construction", "t_event": "Event", "t_flow_incident": "FlowIncident",
    "t_road_blocked": "RoadBlocked",
}
_KNOWN = comma(f"'{c}'" for c in [*_CLASSES.values(), "Other"])


def _count(column: str) -> str:
    if column == "t_other":
        return f"sum(CASE WHEN class IN ({_KNOWN}) THEN 0 ELSE 1 END)::BIGINT AS t_other"
    return f"sum(CASE WHEN class = '{_CLASSES[column]}' THEN 1 ELSE 0 END)::BIGINT AS {column}"


_HASH = "('0x' || substr(md5({}), 1, 8))::BIGINT"
_SPLIT = r"' - |[ .\\/;,&!?()\[\]{}]'"

# Columns whose scaled sum and position-weighted sum make up a sequence checksum.
_TERMS = [
    f"{'s_' + c if c in SCALED_COLUMNS else c}" for c in STEP_FEATURES
]

NAMED = {
    "cities": "SELECT * FROM (VALUES " + comma(
        f"('{c.name}', {i}, {c.lat_min}::DOUBLE, {c.lat_max}::DOUBLE, {c.lng_min}::DOUBLE, "
        f"{c.lng_max}::DOUBLE, '{c.zone}', '{c.name}-{c.state}')" for i, c in enumerate(CITIES)
    ) + ") AS v(city, city_order, lat_min, lat_max, lng_min, lng_max, zone, place)",
    "traffic": f"""
        SELECT event_id, ts AS start_utc, props AS description,
               ts + to_minutes(CAST((event_id % 5) * 20 AS INTEGER)) AS end_utc,
               {_base(30.10, 33.63, 33.72)} + CAST(0.04 AS DOUBLE) * (user_id % 7) AS lat,
               {_base(-97.95, -84.56, -118.67)} + CAST(0.04 AS DOUBLE) * (user_id % 8) AS lng,
               CASE WHEN user_id % 5 = 0 THEN 'X1'
                    WHEN user_id % 3 = 0 THEN CASE WHEN user_id % 2 = 0 THEN 'KAUS' ELSE 'KEDC' END
                    WHEN user_id % 3 = 1 THEN CASE WHEN user_id % 2 = 0 THEN 'KATL' ELSE 'KFTY' END
                    ELSE CASE WHEN user_id % 2 = 0 THEN 'KLAX' ELSE 'KBUR' END END AS airport,
               CASE WHEN event_id % 17 = 0 THEN 'Other' WHEN event_id % 13 = 0 THEN 'Debris-Road'
                    WHEN event_id % 11 = 0 THEN 'Event' WHEN event_id % 7 = 0 THEN 'Flow-Incident'
                    WHEN event_type = 'error' THEN 'Accident'
                    WHEN event_type = 'click' THEN 'Congestion'
                    WHEN event_type = 'purchase' THEN 'Construction'
                    WHEN event_type = 'signup' THEN 'Lane-Blocked'
                    ELSE 'Broken-Vehicle' END AS type
        FROM events""",
    "celled": f"""
        SELECT *, {_cell()} AS cell FROM (
            SELECT *,
                greatest(least(ceil(lng::FLOAT::DOUBLE / 0.0439453125::DOUBLE) + 4095, 8191), 0)::BIGINT AS gx,
                greatest(least(ceil(lat::FLOAT::DOUBLE / 0.0439453125::DOUBLE) + 2047, 4095), 0)::BIGINT AS gy
            FROM traffic)""",
    "in_city": """
        SELECT t.*, c.city, c.city_order, c.zone, c.place,
               (t.start_utc AT TIME ZONE 'UTC') AT TIME ZONE c.zone AS start_local,
               (t.end_utc AT TIME ZONE 'UTC') AT TIME ZONE c.zone AS end_local
        FROM celled t JOIN cities c ON t.lat > c.lat_min AND t.lat < c.lat_max
             AND t.lng > c.lng_min AND t.lng < c.lng_max""",
    "extract": f"""
        SELECT * FROM in_city WHERE start_utc >= TIMESTAMP '{PERIOD[0]}'
               AND start_utc < TIMESTAMP '{PERIOD[1]}'""",
    "placed": f"""
        SELECT * EXCLUDE (raw_end), CASE WHEN raw_end = -1 THEN {TOTAL - 1} ELSE raw_end END AS end_step
        FROM (SELECT *, {_step('start_local')} AS start_step, {_step('end_local')} AS raw_end
              FROM extract) WHERE start_step <> -1""",
    "classed": """
        SELECT *, CASE type WHEN 'Broken-Vehicle' THEN 'BrokenVehicle'
               WHEN 'Flow-Incident' THEN 'FlowIncident' WHEN 'Lane-Blocked' THEN 'RoadBlocked'
               ELSE split_part(type, '-', 1) END AS class FROM traffic""",
    "exploded": """
        SELECT p.*, c.class, unnest(CASE WHEN c.class = 'Accident' THEN [p.start_step]
               ELSE range(p.start_step, p.end_step + 1) END) AS step
        FROM placed p JOIN classed c USING (event_id)""",
    "counts": f"""
        SELECT city, cell, step, {comma(_count(c) for c in TRAFFIC_COLUMNS)}
        FROM exploded GROUP BY city, cell, step""",
    "pairs": "SELECT DISTINCT cell, airport FROM exploded WHERE length(airport) > 3",
    "zones": """
        SELECT airport, arg_max(zone, city_order) AS zone FROM exploded
        WHERE length(airport) > 3 GROUP BY airport""",
    "cells": "SELECT DISTINCT city, cell FROM exploded",
    "centres": f"""
        SELECT cell, radians(-90 + (({_lattice('cell', 'y')}) + 0.5::DOUBLE) * 0.0439453125::DOUBLE) AS lat,
               radians(-180 + (({_lattice('cell', 'x')}) + 0.5::DOUBLE) * 0.0439453125::DOUBLE) AS lng
        FROM (SELECT DISTINCT cell FROM cells)""",
    "donors": """
        SELECT m.cell, arg_min(d.cell, (round(12742.0176::DOUBLE * asin(sqrt(
               pow(sin((d.lat - m.lat) / 2), 2) + cos(m.lat) * cos(d.lat)
               * pow(sin((d.lng - m.lng) / 2), 2))), 6), d.cell)) AS donor
        FROM centres m, centres d
        WHERE m.cell NOT IN (SELECT cell FROM pairs) AND d.cell IN (SELECT cell FROM pairs)
        GROUP BY m.cell""",
    "all_pairs": """
        SELECT cell, airport FROM pairs
        UNION ALL SELECT d.cell, p.airport FROM donors d JOIN pairs p ON p.cell = d.donor""",
    "obs": f"""
        SELECT event_id AS obs_id, ts AS ts_utc,
               ['KAUS', 'KEDC', 'KATL', 'KFTY', 'KLAX', 'KBUR'][user_id % 6 + 1] AS airport,
               {comma(f"CASE WHEN event_id % {k} = 0 THEN -9999.0::DOUBLE ELSE {v} END AS {m}"
                      for m, (k, v) in _MEASURE.items())},
               ['Light Rain , Snow', 'Haze', 'Snow', 'Ice Pellets', '', 'Clear'][event_id % 6 + 1]
                   AS conditions,
               ['Fog', '', 'Hail', NULL][event_id % 4 + 1] AS events
        FROM events""",
    "obs_text": f"""
        SELECT obs_id, airport, strftime(ts_utc, '%Y-%m-%d') AS obs_date,
               CASE WHEN obs_id % 19 = 0 THEN '25:61 xx' ELSE strftime(ts_utc, '%-I:%M %p') END AS obs_hour,
               CASE WHEN obs_id % 23 = 0 THEN 'n/a' ELSE temperature::DECIMAL(18, 3)::VARCHAR END AS temp,
               CASE WHEN obs_id % 29 = 0 THEN '-' ELSE temperature::DECIMAL(18, 3)::VARCHAR END AS wind_chill,
               {comma(f"{m}::DECIMAL(18, 3)::VARCHAR AS {m}" for m in _MEASURE if m != 'temperature')},
               events, conditions
        FROM obs""",
    "first_obs": f"""
        SELECT * FROM (
            SELECT o.*, row_number() OVER (PARTITION BY airport, step ORDER BY ts_utc, obs_id) AS rn
            FROM (SELECT *, {_step('local')} AS step FROM (
                SELECT obs.*, (ts_utc AT TIME ZONE 'UTC') AT TIME ZONE zone AS local
                FROM obs JOIN zones USING (airport))) o
            WHERE step >= 0) WHERE rn = 1""",
    "steps": f"SELECT unnest(range({TOTAL})) AS step",
    "fill": """
        SELECT f.* EXCLUDE (step, prev), s.step FROM (
            SELECT *, coalesce(lag(step) OVER (PARTITION BY airport ORDER BY step), -1) AS prev
            FROM first_obs) f
        JOIN steps s ON s.step > f.prev AND s.step <= f.step""",
    "sky": f"""
        SELECT c.cell, s.step,
               {comma(f"coalesce(avg(CASE WHEN f.{m} > -1000 THEN f.{m} END), 0) AS {w}"
                      for m, w in zip(WEATHER_MEASURES, WEATHER_COLUMNS))},
               {comma(f"max(CASE WHEN {_flag(_WORDS[:i + 1], 'f.conditions')} OR "
                      f"{_flag(_WORDS[:i + 1], 'f.events')} THEN 1 ELSE 0 END)::BIGINT AS {flag}"
                      for i, flag in enumerate(FLAG_COLUMNS))}
        FROM (SELECT DISTINCT cell FROM cells) c CROSS JOIN steps s
        LEFT JOIN all_pairs p ON p.cell = c.cell
        LEFT JOIN fill f ON f.airport = p.airport AND f.step = s.step
        GROUP BY c.cell, s.step""",
    "sun": """
        SELECT place, d::DATE AS day, 7 * 60 + day(d) AS sunrise, 17 * 60 + day(d) AS sunset
        FROM (SELECT DISTINCT ts::DATE AS d FROM events) CROSS JOIN cities WHERE day(d) % 10 <> 0""",
    "light": f"""
        SELECT c.city, s.step, CASE WHEN epoch(t)::BIGINT % 86400 BETWEEN sunrise * 60 AND sunset * 60
               THEN 1 ELSE 0 END::BIGINT AS daylight
        FROM (SELECT step, TIMESTAMP '{WINDOW.begin_text}' + to_minutes(CAST(step * 15 AS INTEGER)) AS t
              FROM steps) s CROSS JOIN cities c
        LEFT JOIN sun ON sun.place = c.place AND sun.day = s.t::DATE""",
    "grid": f"""
        SELECT c.city, c.cell, s.step, isodow(t) - 1 AS dow, hour(t) AS hod, l.daylight,
               {comma(f"coalesce(n.{x}, 0)::BIGINT AS {x}" for x in TRAFFIC_COLUMNS)},
               {comma(f"w.{x}" for x in WEATHER_COLUMNS + FLAG_COLUMNS)}
        FROM cells c CROSS JOIN (
            SELECT step, TIMESTAMP '{WINDOW.begin_text}' + to_minutes(CAST(step * 15 AS INTEGER)) AS t
            FROM steps) s
        JOIN light l ON l.city = c.city AND l.step = s.step
        JOIN sky w ON w.cell = c.cell AND w.step = s.step
        LEFT JOIN counts n ON n.city = c.city AND n.cell = c.cell AND n.step = s.step""",
    "labelled": """
        SELECT * REPLACE (CASE WHEN t_accident > 0 THEN 1 ELSE 0 END::BIGINT AS t_accident),
               CASE WHEN next_count IS NULL THEN NULL WHEN next_count > 0 THEN 1 ELSE 0 END::BIGINT
                   AS predicted_accident
        FROM (SELECT *, lead(t_accident) OVER (PARTITION BY city, cell ORDER BY step) AS next_count
              FROM grid)
        WHERE next_count IS NOT NULL""",
    "poi": f"""
        SELECT cell, {comma(f"sum(CASE WHEN event_id % 14 = {j} THEN 1 ELSE 0 END)::BIGINT AS p{j}"
                            for j in range(13))}, 1::BIGINT AS p13
        FROM celled GROUP BY cell HAVING min(event_id) % 8 <> 0""",
    "poi_scaled": "SELECT cell, " + comma(
        f"CASE WHEN max(p{j}) OVER () = min(p{j}) OVER () THEN 0.5::DOUBLE ELSE "
        f"(p{j} - min(p{j}) OVER ()) / (max(p{j}) OVER () - min(p{j}) OVER ())::DOUBLE END AS q{j}"
        for j in range(14)) + " FROM poi",
    "poi_long": " UNION ALL ".join(
        f"SELECT cell, {j}::BIGINT AS pos, q{j} AS value FROM poi_scaled" for j in range(14)),
    "codes": "SELECT cell, row_number() OVER (ORDER BY cell) - 1 AS cell_code FROM poi",
    "clean": """
        SELECT g.*, k.cell_code, CASE WHEN dow < 5 THEN 1 ELSE 0 END::BIGINT AS dow_cat,
               CASE WHEN hod >= 6 AND hod < 10 THEN 0 WHEN hod >= 10 AND hod < 15 THEN 1
                    WHEN hod >= 15 AND hod < 18 THEN 2 WHEN hod >= 18 AND hod < 22 THEN 3
                    ELSE 4 END::BIGINT AS hod_cat
        FROM labelled g JOIN codes k USING (cell)""",
    "split_rows": """
        SELECT *, CASE WHEN step <= max(step) OVER (PARTITION BY city) * 5 / 6.0
               THEN 'train' ELSE 'test' END AS split FROM clean""",
    "ranges": "SELECT city, " + comma(
        f"min({c})::DOUBLE AS lo_{c}, CASE WHEN max({c}) = min({c}) THEN 1.0 "
        f"ELSE max({c}) - min({c}) END::DOUBLE AS wd_{c}" for c in SCALED_COLUMNS
    ) + " FROM split_rows WHERE split = 'train' GROUP BY city",
    "scaled": "SELECT g.*, " + comma(
        f"(g.{c} - r.lo_{c}) / r.wd_{c} AS s_{c}" for c in SCALED_COLUMNS
    ) + ", " + comma(
        f"CASE WHEN hod_cat = {i} THEN 1.0 ELSE 0.0 END::DOUBLE AS {h}" for i, h in enumerate(HOUR_COLUMNS)
    ) + " FROM split_rows g JOIN ranges r USING (city)",
    "docs": "SELECT doc_id, text FROM documents",
    "doc_tokens": f"""
        SELECT doc_id, word FROM (
            SELECT doc_id, lower(unnest(regexp_split_to_array(text, {_SPLIT}))) AS word FROM docs)
        WHERE length(word) > 0""",
    "doc_words": "SELECT doc_id, word, count(*) AS uses FROM doc_tokens GROUP BY doc_id, word",
    "vocabulary": f"""
        SELECT DISTINCT word, {_HASH.format('word')} % (SELECT count(*) FROM embeddings) AS vec_id
        FROM doc_words WHERE NOT regexp_matches(word, '\\s')""",
    "vec_long": """
        SELECT vec_id, unnest(range(len(embedding))) AS pos, unnest(embedding)::DOUBLE AS value
        FROM embeddings""",
    "doc_mean": """
        SELECT doc_id, pos, sum(uses * value) / sum(uses) AS value
        FROM doc_words JOIN vocabulary USING (word) JOIN vec_long USING (vec_id)
        GROUP BY doc_id, pos""",
    "cell_text": """
        SELECT cell, pos, avg(value) AS value
        FROM (SELECT cell, event_id % (SELECT count(*) FROM documents) AS doc_id FROM extract
              WHERE cell IN (SELECT cell FROM poi)) JOIN doc_mean USING (doc_id)
        GROUP BY cell, pos""",
    "example": f"""
        SELECT s.city, s.split, s.cell, s.step, s.predicted_accident AS label,
               {len(STEP_FEATURES) * LOOKBACK + 14 + DIMS + 1}::BIGINT AS width,
               round(seq + poi_part + coalesce(text_part, 0)
                     + cell_code * {len(STEP_FEATURES) * LOOKBACK + 14 + DIMS + 1}, 4) AS checksum
        FROM (SELECT *, row_number() OVER w AS position, {" + ".join(
                  f"{len(STEP_FEATURES) * k} * lag(plain, {LOOKBACK - k}) OVER w + lag(weighted, {LOOKBACK - k}) OVER w"
                  for k in range(LOOKBACK))} AS seq
              FROM (SELECT *, {" + ".join(_TERMS)} AS plain,
                    {" + ".join(f"{i + 1} * {t}" for i, t in enumerate(_TERMS))} AS weighted FROM scaled)
              WINDOW w AS (PARTITION BY city, cell, split ORDER BY step)) s
        JOIN (SELECT cell, sum(value * ({len(STEP_FEATURES) * LOOKBACK} + pos + 1)) AS poi_part
              FROM poi_long GROUP BY cell) p USING (cell)
        LEFT JOIN (SELECT cell, sum(value * ({len(STEP_FEATURES) * LOOKBACK + 14} + pos + 1)) AS text_part
              FROM cell_text GROUP BY cell) t USING (cell)
        WHERE position > {LOOKBACK} AND (predicted_accident > 0 OR
              {_HASH.format("'42|' || cell || '|' || step")} % 10000 >= 9800)""",
    "confusion": "SELECT quality AS label, toxic AS prediction, count(*) AS n FROM labels GROUP BY ALL",
    "per_class": """
        SELECT c.label AS class, sum(n) AS actual,
               coalesce((SELECT sum(n) FROM confusion x WHERE x.prediction = c.label), 0) AS guessed,
               coalesce(sum(n) FILTER (c.prediction = c.label), 0) AS hits
        FROM confusion c GROUP BY c.label""",
}


def _needed(text: str) -> list[str]:
    found: list[str] = []
    for name in NAMED:
        if re.search(rf"\b(?:FROM|JOIN|,)\s+{name}\b", text):
            for inner in _needed(NAMED[name]):
                if inner not in found:
                    found.append(inner)
            if name not in found:
                found.append(name)
    return found


def sql(select: str) -> str:
    named = _needed(select)
    head = "WITH " + ",\n".join(f"{n} AS ({NAMED[n]})" for n in named) + "\n" if named else ""
    return head + select


def _rounded(columns) -> str:
    return comma(r6(c, c) if c in WEATHER_COLUMNS else c for c in columns)


_W = f"OVER (PARTITION BY city, cell, split ORDER BY step)"
_SEQ = ("t_accident", "daylight", "w_rain")

ORACLE = {name: sql(text) for name, text in {
    "scan_events": """SELECT epoch_us(start_utc) AS start_us, epoch_us(end_utc) AS end_us, lat, lng,
        airport, type, description FROM traffic""",
    "sink_roundtrip_extract": """SELECT city, event_id, epoch_us(start_utc) AS start_us, type
        FROM extract""",
    "scan_word_vectors": f"""SELECT word, count(*) AS dims, {r6('sum(value * (pos + 1))', 'checksum')}
        FROM vocabulary JOIN vec_long USING (vec_id) GROUP BY word""",
    "scan_poi": "SELECT cell, " + comma(
        f"p{j} AS {n.lower()}" for j, n in enumerate(POI_FIELDS)) + " FROM poi",
    "scan_weather": """SELECT airport, obs_date, obs_hour, temp, wind_chill, humidity, pressure,
        visibility, wind_speed, precipitation,
        nullif(events, '') AS events_tag, nullif(conditions, '') AS conditions_tag
        FROM obs_text WHERE airport IN (SELECT airport FROM zones)""",
    "scan_daylight": """SELECT place, strftime(day, '%Y-%m-%d') AS day, sunrise::BIGINT AS sunrise,
        (5 * 60 + day(day) + 720)::BIGINT AS sunset FROM sun""",
    "sink_roundtrip_vectors": f"SELECT cell, pos, {r6('value', 'value')} FROM cell_text",
    "sink_roundtrip_grid": f"SELECT city, {_rounded(RAW_GRID_COLUMNS)} FROM grid",
    "sink_roundtrip_clean_grid": f"""SELECT city, step, predicted_accident, cell, cell_code, hod_cat, dow_cat,
        t_accident, daylight, {_rounded(SCALED_COLUMNS)} FROM clean""",
    "sink_roundtrip_trainset": """SELECT city, split, label, count(*) AS n_examples,
        max(width) AS width FROM example GROUP BY city, split, label""",
    "bbox_time_filter": "SELECT event_id, city FROM extract",
    "city_range_join": "SELECT event_id, city, zone FROM in_city",
    "geohash_cell": "SELECT event_id, cell FROM celled",
    "valid_cell_semi_join": """SELECT event_id, cell FROM celled
        WHERE cell IN (SELECT cell FROM poi)""",
    "event_type_normalize": "SELECT event_id, type, class AS event_class FROM classed",
    "local_time": """SELECT event_id, city, epoch_us(start_local) AS start_local_us,
        epoch_us(end_local) AS end_local_us FROM in_city""",
    "interval_index": f"""SELECT event_id, city, {_step('start_local')} AS start_step,
        {_step('end_local')} AS end_step FROM in_city""",
    "interval_clamp": "SELECT event_id, city, start_step, end_step FROM placed",
    "span_explode": "SELECT event_id, city, step FROM exploded",
    "calendar_features": """SELECT event_id, start_step AS step, (isodow(slot) - 1)::BIGINT AS dow,
        hour(slot)::BIGINT AS hod, CASE WHEN isodow(slot) < 6 THEN 1 ELSE 0 END::BIGINT AS dow_cat,
        CASE WHEN hour(slot) BETWEEN 6 AND 9 THEN 0 WHEN hour(slot) BETWEEN 10 AND 14 THEN 1
             WHEN hour(slot) BETWEEN 15 AND 17 THEN 2 WHEN hour(slot) BETWEEN 18 AND 21 THEN 3
             ELSE 4 END::BIGINT AS hod_cat
        FROM (SELECT *, time_bucket(INTERVAL '15 minutes', start_local) AS slot FROM placed)""",
    "hour_onehot": "SELECT event_id, " + comma(
        f"CASE WHEN hour(start_local) IN ({comma(str(h) for h in hours)}) THEN 1.0 ELSE 0.0 END::DOUBLE "
        f"AS {name}" for name, hours in zip(
            HOUR_COLUMNS, (range(6, 10), range(10, 15), range(15, 18), range(18, 22),
                           [22, 23, *range(6)]))) + " FROM placed",
    "weather_parse_reject": f"""
        SELECT obs_id, airport, strftime(t, '%Y-%m-%d %H:%M') AS local_minute,
               CASE WHEN t IS NULL THEN 'time'
                    WHEN {" OR ".join(f"{m} IS NULL" for m in (*_MEASURE, 'wind_chill'))}
                    THEN 'number' END AS reject,
               {comma(r6(m, m) for m in (*_MEASURE, 'wind_chill'))}
        FROM (SELECT obs_id, airport,
              try_strptime(obs_date || ' ' || obs_hour, '%Y-%m-%d %I:%M %p') AS t,
              try_cast(temp AS DOUBLE) AS temperature, try_cast(wind_chill AS DOUBLE) AS wind_chill,
              {comma(f"try_cast({m} AS DOUBLE) AS {m}" for m in _MEASURE if m != 'temperature')}
              FROM obs_text)""",
    "tokenize": f"""
        SELECT doc_id, len(words)::BIGINT AS n_tokens, md5(array_to_string(words, '|')) AS digest
        FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), {_SPLIT}),
              lambda t: length(t) > 0) AS words FROM docs)""",
    "vector_parse": f"SELECT vec_id, pos, {r6('value', 'value')} FROM vec_long",
    "cell_step_counts": "SELECT * FROM counts",
    "cell_airports": "SELECT * FROM pairs",
    "airport_zone": "SELECT * FROM zones",
    "nearest_cell_airports": "SELECT * FROM all_pairs",
    "next_obs_fill": f"""SELECT airport, step, {comma(r6(m, m) for m in WEATHER_MEASURES)},
        conditions AS conditions_tag, events AS events_tag FROM fill""",
    "weather_cell_mean": f"SELECT cell, step, {_rounded(WEATHER_COLUMNS)} FROM sky",
    "weather_flags": f"SELECT cell, step, {comma(FLAG_COLUMNS)} FROM sky",
    "daylight_flag": "SELECT * FROM light",
    "dense_grid": f"SELECT city, {_rounded(RAW_GRID_COLUMNS)} FROM grid",
    "next_step_label": """SELECT city, cell, step, t_accident, predicted_accident FROM labelled""",
    "grid_project": f"""SELECT city, step, predicted_accident, cell, cell_code, hod_cat, dow_cat,
        t_accident, daylight, {_rounded(SCALED_COLUMNS)} FROM clean""",
    "token_vector_join": f"""
        SELECT doc_id, word, uses, {r6('embedding[1]::DOUBLE', 'v_first')},
               {r6(f'embedding[{DIMS}]::DOUBLE', 'v_last')}
        FROM doc_words JOIN vocabulary USING (word) JOIN embeddings USING (vec_id)""",
    "doc_vector_mean": f"SELECT doc_id, pos, {r6('value', 'value')} FROM doc_mean",
    "cell_text_vector": f"SELECT cell, pos, {r6('value', 'value')} FROM cell_text",
    "poi_minmax": f"SELECT cell, pos, {r6('value', 'value')} FROM poi_long",
    "cell_code": "SELECT * FROM codes",
    "attach_poi": f"""SELECT event_id, cell, checksum FROM extract JOIN (
        SELECT cell, {r6('sum(value * (pos + 1))', 'checksum')} FROM poi_long GROUP BY cell) USING (cell)""",
    "attach_text": f"""SELECT event_id, cell, coalesce(checksum, 0.0) AS checksum FROM extract LEFT JOIN (
        SELECT cell, {r6('sum(value * (pos + 1))', 'checksum')} FROM cell_text GROUP BY cell) USING (cell)""",
    "chrono_split": "SELECT city, cell, step, split FROM split_rows",
    "split_minmax": "SELECT city, cell, step, split, " + comma(
        r6(f"s_{c}", c) for c in SCALED_COLUMNS) + " FROM scaled",
    "lookback_sequence": f"""
        SELECT city, cell, split, step, {len(_SEQ) * LOOKBACK}::BIGINT AS width,
               checksum::DOUBLE AS checksum
        FROM (SELECT *, row_number() {_W} AS position, {" + ".join(
            f"{len(_SEQ) * k + f + 1} * lag({c}, {LOOKBACK - k}) {_W}"
            for k in range(LOOKBACK) for f, c in enumerate(_SEQ))} AS checksum FROM split_rows)
        WHERE position > {LOOKBACK}""",
    "negative_sample": f"""SELECT city, cell, step, predicted_accident AS label FROM clean
        WHERE predicted_accident > 0
              OR {_HASH.format("'42|' || cell || '|' || step")} % 10000 >= 9800""",
    "assemble_example": "SELECT * FROM example",
    "fit_logreg": """SELECT city, any_value(width) AS width, count(*) FILTER (split = 'train') AS train_rows,
        count(*) FILTER (split = 'test') AS test_rows,
        count(*) FILTER (split = 'test' AND label > 0) AS test_positives,
        true AS accuracy_is_recall, true AS within_0_1
        FROM example GROUP BY city HAVING train_rows > 0 AND test_rows > 0""",
    "class_metrics": f"""SELECT {r6('sum(hits) / sum(actual)', 'accuracy')},
        {r6('sum(actual * (hits / actual)) / sum(actual)', 'weighted_recall')},
        {r6('sum(actual * 2 * hits / (guessed + actual)) / sum(actual)', 'weighted_f1')}
        FROM per_class""",
}.items()}
