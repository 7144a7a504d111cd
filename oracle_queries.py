"""DuckDB SQL for the registered queries, over the driver's tables."""

from clickflow.schemas import STEP_LABELS, VISIT_LABELS

ACTION_COLUMNS = """strftime(day, '%Y-%m-%d') AS date, user_id, session_id, page_id,
  strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time, search_keyword, click_category_id,
  click_product_id, order_category_ids, order_product_ids, pay_category_ids, pay_product_ids"""

TABLES = """
ev AS (
  SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day,
         CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k,
         hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS s
  FROM events),
uva AS (
  SELECT event_id, day, user_id,
         CAST(user_id AS VARCHAR) || '_' || strftime(day, '%Y%m%d') AS session_id,
         k % 10 AS page_id,
         CAST(day AS TIMESTAMP) + to_hours(CAST(user_id % 24 AS INTEGER)) + to_seconds(s // 24) AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || CAST(k % 10 AS VARCHAR) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k END AS click_category_id,
         CASE WHEN event_type = 'click' THEN event_id % 100 END AS click_product_id,
         CASE WHEN event_type = 'purchase'
              THEN CAST(k AS VARCHAR) || ',' || CAST(k * 7 % 100 AS VARCHAR) END AS order_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(event_id % 100 AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(event_id % 100 AS VARCHAR) END AS pay_product_ids
  FROM ev),
ui AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
         CAST(10 + c_custkey % 50 AS INTEGER) AS age, c_mktsegment AS professional, n_name AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

ROLLED = """
  SELECT session_id, min(user_id) AS user_id,
         coalesce(array_to_string(list_sort(list(DISTINCT search_keyword)
           FILTER (WHERE search_keyword <> '')), ','), '') AS search_keywords,
         coalesce(array_to_string(list_sort(list(DISTINCT click_category_id)
           FILTER (WHERE click_category_id IS NOT NULL)), ','), '') AS click_category_ids,
         CAST(date_diff('second', min(action_time), max(action_time)) AS BIGINT) AS visit_length,
         CAST(count(*) AS BIGINT) AS step_length,
         min(action_time) AS start_time
  FROM {actions} WHERE session_id IS NOT NULL GROUP BY session_id"""

TIME_TEXT = "strftime(start_time, '%Y-%m-%d %H:%M:%S')"
SESSION_COLUMNS = f"""session_id, user_id, search_keywords, click_category_ids, visit_length, step_length,
  {TIME_TEXT} AS start_time"""
USER_COLUMNS = "age, professional, city, sex"

# Band edges, both ends included; no upper end means open.
VISIT_EDGES = ((1, 3), (4, 6), (7, 9), (10, 30), (31, 60), (61, 180), (181, 600), (601, 1800), (1801, None))
STEP_EDGES = ((1, 3), (4, 6), (7, 9), (10, 30), (31, 60), (61, None))


def _held(column, edge):
    low, high = edge
    return f"{column} >= {low}" if high is None else f"{column} BETWEEN {low} AND {high}"


def _bands(labels, edges, column, source="rolled", name="band", value="sessions"):
    return "\nUNION ALL ".join(
        f"SELECT '{label}' AS {name}, CAST(count(*) FILTER (WHERE {_held(column, edge)}) AS BIGINT) AS {value} FROM {source}"
        for label, edge in zip(labels, edges, strict=True)
    )


def _ratio(part, total):
    return (
        f"CASE WHEN {total} = 0 THEN 0.0 "
        f"ELSE CAST((200 * {part} + {total}) // (2 * {total}) AS DOUBLE) / 100 END"
    )


def _texts(csv):
    return "[" + ", ".join(f"'{value}'" for value in csv.split(",")) + "]"


def build(task, task_id, sample_size, seed, flow):
    value = {name: values[0] for name, values in task.items()}
    dates = f"day BETWEEN DATE '{value['startDate']}' AND DATE '{value['endDate']}'"
    age = f"age BETWEEN {value['startAge']} AND {value['endAge']}"
    professional = f"list_contains({_texts(value['professionals'])}, professional)"
    city = f"list_contains({_texts(value['cities'])}, city)"
    sex = f"sex = '{value['sex']}'"
    keywords = f"list_has_any(string_split(search_keywords, ','), {_texts(value['keywords'])})"
    category = f"list_has_any(string_split(click_category_ids, ','), {_texts(value['categoryIds'])})"
    wide = f"{age} AND {professional} AND {sex}"

    def query(body, where="true", kept="true", source="uva"):
        """``body`` over acts (actions), rolled (their sessions), known (with users), kept."""
        return f"""WITH {TABLES},
acts AS (SELECT * FROM {source} WHERE {where}),
rolled AS ({ROLLED.format(actions="acts")}),
known AS (SELECT rolled.*, {USER_COLUMNS} FROM rolled JOIN ui USING (user_id)),
kept AS (SELECT * FROM known WHERE {kept})
{body}"""

    def ids(kept):
        return query("SELECT session_id FROM kept", dates, kept)

    gapped = """(SELECT * REPLACE (CASE WHEN event_id % 50 <> 0 THEN session_id END AS session_id,
    CASE WHEN user_id % 7 <> 0 AND event_id % 31 <> 0 THEN action_time END AS action_time) FROM uva)"""

    detail = f"""SELECT CAST({task_id} AS BIGINT) AS task_id, user_id, session_id, page_id,
  strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time, search_keyword, click_category_id,
  click_product_id, order_category_ids, order_product_ids, pay_category_ids, pay_product_ids
FROM acts WHERE session_id IN (SELECT session_id FROM chosen)"""

    hours = """hours AS (
  SELECT strftime(start_time, '%Y-%m-%d') AS date, CAST(hour(start_time) AS INTEGER) AS hour,
         CAST(count(*) AS BIGINT) AS sessions FROM kept WHERE start_time IS NOT NULL GROUP BY ALL),"""
    quotas = f""", {hours}
quotas AS (
  SELECT date, hour, sessions,
         least(CAST(floor(CAST(sessions AS DOUBLE) / CAST(sum(sessions) OVER (PARTITION BY date) AS DOUBLE)
           * CAST({sample_size} // (SELECT count(DISTINCT date) FROM hours) AS DOUBLE)) AS BIGINT), sessions) AS quota
  FROM hours)"""
    chosen = f"""{quotas},
keyed AS (
  SELECT kept.*, quota, row_number() OVER (
    PARTITION BY date, hour ORDER BY md5(session_id || '{seed}'), session_id) AS rank
  FROM kept JOIN quotas ON date = strftime(start_time, '%Y-%m-%d') AND hour = hour(start_time)),
chosen AS (SELECT * FROM keyed WHERE rank <= quota)
"""
    def touched(condition):
        return f""", source AS (SELECT * FROM acts WHERE {condition}), touches AS (
  SELECT session_id, kind, unnest(ids) AS category_id FROM (
    SELECT session_id, 'click' AS kind, [click_category_id] AS ids FROM source WHERE click_category_id IS NOT NULL
    UNION ALL SELECT session_id, 'order',
      list_transform(string_split(order_category_ids, ','), lambda x: CAST(x AS BIGINT))
      FROM source WHERE order_category_ids <> ''
    UNION ALL SELECT session_id, 'pay',
      list_transform(string_split(pay_category_ids, ','), lambda x: CAST(x AS BIGINT))
      FROM source WHERE pay_category_ids <> ''))
"""

    touches = touched("session_id IN (SELECT session_id FROM kept)")

    def category_count(kind):
        body = f"SELECT category_id, CAST(count(*) AS BIGINT) AS n FROM touches WHERE kind = '{kind}' GROUP BY category_id"
        return query(touches + body, dates, wide)

    top = """, top AS (
  SELECT category_id,
         CAST(count(*) FILTER (WHERE kind = 'click') AS BIGINT) AS click_count,
         CAST(count(*) FILTER (WHERE kind = 'order') AS BIGINT) AS order_count,
         CAST(count(*) FILTER (WHERE kind = 'pay') AS BIGINT) AS pay_count
  FROM touches GROUP BY category_id
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10)
"""
    def active(k):
        return f""", active AS (
  SELECT category_id, session_id, click_count FROM (
    SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS rank
    FROM (SELECT category_id, session_id, CAST(count(*) AS BIGINT) AS click_count
          FROM touches WHERE kind = 'click' AND category_id IN (SELECT category_id FROM top)
          GROUP BY ALL))
  WHERE rank <= {k})
"""

    ranked = touches + top + active(10)

    def slices(order):
        return f""", steps AS (
  SELECT page_id, lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time NULLS FIRST, {order}) AS next_page_id
  FROM acts WHERE session_id IS NOT NULL),
slices AS (
  SELECT page_id, next_page_id, CAST(count(*) AS BIGINT) AS n FROM steps
  WHERE next_page_id IS NOT NULL GROUP BY ALL)
"""

    hops = list(zip(flow, flow[1:]))
    hop_rows = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(hops, 1))
    target = f", hops(i, a, b) AS (VALUES {hop_rows})\n"
    hop_name = "CAST(a AS VARCHAR) || '_' || CAST(b AS VARCHAR) AS slice"
    conversion = f""", matched AS (
  SELECT i, {hop_name}, coalesce(n, 0) AS n
  FROM hops LEFT JOIN slices ON page_id = a AND next_page_id = b),
based AS (
  SELECT i, slice, n, coalesce(lag(n) OVER (ORDER BY i),
    (SELECT count(*) FROM acts WHERE page_id = {flow[0]})) AS base FROM matched)
SELECT slice, CAST(n AS BIGINT) AS n, {_ratio("n", "base")} AS rate FROM based"""

    stat_columns = ",\n  ".join(
        _ratio(f"count(*) FILTER (WHERE {_held(column, edge)})", "count(*)")
        + f" AS {column}_{label}_ratio"
        for column, labels, edges in (
            ("visit_length", VISIT_LABELS, VISIT_EDGES),
            ("step_length", STEP_LABELS, STEP_EDGES),
        )
        for label, edge in zip(labels, edges, strict=True)
    )
    stat = query(
        f"SELECT CAST({task_id} AS BIGINT) AS taskid, CAST(count(*) AS BIGINT) AS session_count,\n  {stat_columns}\nFROM kept",
        dates,
        wide,
    )

    pairs = (
        ("sessionId", "session_id"),
        ("searchKeyWords", "search_keywords"),
        ("clickCategoryIds", "click_category_ids"),
        ("visitLength", "visit_length"),
        ("stepLength", "{steps}"),
        ("startTime", TIME_TEXT),
        ("age", "age"),
        ("professional", "professional"),
        ("city", "city"),
        ("sex", "sex"),
    )

    def encoded(steps="step_length"):
        return " || '|' || ".join(
            f"'{key}=' || coalesce(CAST({column.format(steps=steps)} AS VARCHAR), 'null')" for key, column in pairs
        )

    def rounded(name, sign=""):
        """Half-up at two decimals on the exact binary value, in wide integers."""
        shift = f"(53 - CAST(floor(log2({name})) AS BIGINT))"
        power = f"CAST(pow(2.0, {shift}) AS HUGEINT)"
        mantissa = f"CAST({name} * pow(2.0, {shift}) AS HUGEINT)"
        return (
            f"CASE WHEN {name} = 0 THEN 0.0 ELSE "
            f"{sign}CAST(({mantissa} * 200 + {power}) // (2 * {power}) AS DOUBLE) / 100 END"
        )

    extract_body = (
        chosen
        + f"""SELECT CAST({task_id} AS BIGINT) AS task_id, session_id, {TIME_TEXT} AS start_time,
  nullif(search_keywords, '') AS search_keywords, nullif(click_category_ids, '') AS click_category_ids FROM chosen"""
    )
    extract = query(extract_body)
    sampled_detail = query(chosen + detail)
    text = "SELECT session_id, {} FROM known"

    counted = query(
        "SELECT 'session_count' AS counter, CAST(count(*) AS BIGINT) AS value FROM kept\nUNION ALL "
        + _bands(VISIT_LABELS, VISIT_EDGES, "visit_length", "kept", "counter", "value")
        + "\nUNION ALL "
        + _bands(STEP_LABELS, STEP_EDGES, "step_length", "kept", "counter", "value"),
        dates,
        wide,
    )

    return {
        "actions_date_range": query(f"SELECT {ACTION_COLUMNS} FROM acts", dates),
        "session_rollup": query(f"SELECT {SESSION_COLUMNS} FROM rolled"),
        "session_full": query(f"SELECT {SESSION_COLUMNS}, {USER_COLUMNS} FROM known"),
        "filter_age": ids(age),
        "filter_professional_city": ids(f"{professional} AND {city}"),
        "filter_sex": ids(sex),
        "filter_keywords": ids(keywords),
        "filter_categories": ids(category),
        "filter_all": query(
            f"SELECT {SESSION_COLUMNS}, {USER_COLUMNS} FROM kept", dates, f"{wide} AND {city} AND {keywords}"
        ),
        "task_filter": ids(f"{wide} AND {city} AND {keywords} AND {category}"),
        "session_analysis": query(
            ranked + chosen.replace("chosen AS", "sampled AS") + slices("event_id") + target
            + """SELECT 'session_aggr_stat' AS "table", CAST(1 AS BIGINT) AS n
UNION ALL SELECT 'session_random_extract', count(*) FROM sampled
UNION ALL SELECT 'session_detail', count(*) FROM acts WHERE session_id IN (SELECT session_id FROM sampled)
UNION ALL SELECT 'top10_category', count(*) FROM top
UNION ALL SELECT 'top10_session', count(*) FROM active
UNION ALL SELECT 'top10_session_detail', count(*) FROM acts WHERE session_id IN (SELECT session_id FROM active)
UNION ALL SELECT 'page_conversion', count(*) FROM hops""",
            dates,
            wide,
        ),
        "visit_bands": query(_bands(VISIT_LABELS, VISIT_EDGES, "visit_length")),
        "step_bands": query(_bands(STEP_LABELS, STEP_EDGES, "step_length")),
        "band_counters": counted,
        "session_aggr_stat": stat,
        "sink_roundtrip": stat,
        "sessions_per_hour": query(
            "SELECT strftime(start_time, '%Y-%m-%d_%H') AS date_hour, CAST(count(*) AS BIGINT) AS sessions FROM kept GROUP BY ALL"
        ),
        "sample_quota": query(quotas + "SELECT date, hour, sessions, quota FROM quotas"),
        "session_random_extract": extract,
        "sink_extract_roundtrip": extract,
        "session_detail": sampled_detail,
        "sink_detail_roundtrip": sampled_detail,
        "kept_session_actions": query(
            f"SELECT {ACTION_COLUMNS} FROM acts WHERE session_id IN (SELECT session_id FROM kept)", dates, wide
        ),
        "category_touches": query(touched("true") + "SELECT * FROM touches"),
        "categories_touched": query(touches + "SELECT DISTINCT category_id FROM touches", dates, wide),
        "category_clicks": category_count("click"),
        "category_orders": category_count("order"),
        "category_pays": category_count("pay"),
        "top10_categories": query(touches + top + "SELECT * FROM top", dates, wide),
        "top10_category_sessions": query(ranked + "SELECT * FROM active", dates, wide),
        "top5_sessions_of_top20": query(
            touches + top.replace("LIMIT 10", "LIMIT 20") + active(5) + "SELECT * FROM active", dates, wide
        ),
        "gaps_band_counters": query(
            "SELECT 'session_count' AS counter, CAST(count(*) AS BIGINT) AS value FROM kept\nUNION ALL "
            + _bands(VISIT_LABELS, VISIT_EDGES, "visit_length", "kept", "counter", "value")
            + "\nUNION ALL "
            + _bands(STEP_LABELS, STEP_EDGES, "step_length", "kept", "counter", "value"),
            source=gapped,
        ),
        "gaps_sample": query(quotas + "SELECT date, hour, sessions, quota, quota AS drawn FROM quotas", source=gapped),
        "gaps_page_slices": query(slices("event_id") + "SELECT * FROM slices", source=gapped),
        "job_session_aggr_stat": stat,
        "job_session_random_extract": query(extract_body, dates, wide),
        "job_session_detail": query(chosen + detail, dates, wide),
        "job_top10_category": query(ranked + f"SELECT CAST({task_id} AS BIGINT) AS task_id, * FROM top", dates, wide),
        "job_top10_session": query(ranked + f"SELECT CAST({task_id} AS BIGINT) AS task_id, * FROM active", dates, wide),
        "job_top10_session_detail": query(
            ranked + ", chosen AS (SELECT DISTINCT session_id FROM active)\n" + detail, dates, wide
        ),
        "job_page_conversion": query(
            slices("event_id") + target + conversion.replace("SELECT slice, CAST(n", f"SELECT CAST({task_id} AS BIGINT) AS task_id, slice, CAST(n"), dates
        ),
        "sink_bucketed_roundtrip": query(f"SELECT {ACTION_COLUMNS} FROM acts"),
        "top10_session_detail": query(
            ranked + ", chosen AS (SELECT DISTINCT session_id FROM active)\n" + detail, dates, wide
        ),
        "page_slices": query(slices("event_id") + "SELECT * FROM slices"),
        "page_slices_by_page": query(slices("page_id") + "SELECT * FROM slices"),
        "page_flow_matches": query(
            slices("event_id") + target
            + f"SELECT {hop_name}, n FROM slices JOIN hops ON page_id = a AND next_page_id = b"
        ),
        "page_conversion": query(slices("event_id") + target + conversion),
        "row_counts": query(
            """SELECT 'user_visit_action' AS "table", CAST(count(*) AS BIGINT) AS n FROM acts
UNION ALL SELECT 'user_info', count(*) FROM ui UNION ALL SELECT 'session', count(*) FROM rolled"""
        ),
        "first_sessions": query(
            f"SELECT session_id, user_id, visit_length, step_length, {TIME_TEXT} AS start_time FROM rolled ORDER BY session_id LIMIT 10"
        ),
        "kv_encode": query(text.format(f"{encoded()} AS text")),
        "kv_get": query(
            text.format(
                "nullif(search_keywords, '') AS search_keywords, CAST(visit_length AS VARCHAR) AS visit_length, "
                "city, CAST(NULL AS VARCHAR) AS missing"
            )
        ),
        "kv_set": query(text.format(f"{encoded('0')} AS text, {encoded()} AS unchanged")),
        "string_exprs": query(
            """SELECT event_id, CAST(coalesce(search_keyword, '') = '' AS INTEGER) AS empty,
  CAST(coalesce(search_keyword, '') <> '' AS INTEGER) AS not_empty,
  coalesce(order_category_ids, CASE WHEN order_category_ids IS NULL THEN '' END) AS trimmed,
  CASE WHEN length(CAST(user_id AS VARCHAR)) = 2 THEN '' ELSE '0' END || CAST(user_id AS VARCHAR) AS padded,
  replace(order_category_ids, ',', ';') AS ids FROM acts"""
        ),
        "date_exprs": query(
            """SELECT event_id, CAST(action_time < noon AS INTEGER) AS before, CAST(action_time > noon AS INTEGER) AS after,
  CAST(date_diff('second', noon, action_time) AS INTEGER) AS minus, CAST(0 AS INTEGER) AS minus_bad,
  strftime(action_time, '%Y-%m-%d_%H') AS date_hour, strftime(day, '%Y-%m-%d') AS date,
  strftime(action_time, '%Y-%m-%d %H:%M:%S') AS time, strftime(day, '%Y-%m-%d') AS today,
  strftime(day - INTERVAL 1 DAY, '%Y-%m-%d') AS yesterday
FROM (SELECT *, CAST(day AS TIMESTAMP) + INTERVAL 12 HOUR AS noon FROM acts)"""
        ),
        "ratio_half_up": query(
            f"""SELECT user_id, clicks, actions, {_ratio("clicks", "actions")} AS rate FROM (
  SELECT user_id, CAST(count(click_category_id) AS BIGINT) AS clicks, CAST(count(*) AS BIGINT) AS actions
  FROM acts GROUP BY user_id)"""
        ),
        "format_double": f"""SELECT event_id, {rounded("a")} AS eighth, {rounded("b", "-")} AS small
FROM (SELECT event_id, abs(value) / 8 AS a, abs(value) / 1000 AS b FROM events)""",
        "json_exprs": """SELECT event_id, event_type AS first, CAST(NULL AS VARCHAR) AS missing,
  regexp_extract(props, '[0-9]+') AS k FROM events""",
        "view_roundtrip": query(f"SELECT {ACTION_COLUMNS} FROM acts"),
        "sink_actions_roundtrip": query(f"SELECT {ACTION_COLUMNS} FROM acts"),
        "sink_users_roundtrip": query("SELECT * FROM ui"),
        "sink_users_merged": query(
            "SELECT * REPLACE (CASE WHEN sex = 'female' THEN 'new ' || name ELSE name END AS name) FROM ui"
        ),
        "sink_actions_rewritten": query(
            f"""SELECT {ACTION_COLUMNS} FROM acts
WHERE click_category_id IS NOT NULL OR day(day) % 2 = 1
  OR day NOT IN (SELECT day FROM acts WHERE click_category_id IS NOT NULL)"""
        ),
        "rollup_from_states": query(f"SELECT {SESSION_COLUMNS} FROM rolled"),
        "weekly_rollup_from_states": query(
            f"SELECT {SESSION_COLUMNS} FROM rolled",
            source="(SELECT * REPLACE (user_id || '_w' || weekofyear(day) AS session_id) FROM uva)",
        ),
        "filter_from_states": ids(f"{wide} AND {city} AND {keywords} AND {category}"),
        "merged_counters": counted,
        "stat_from_counters": stat,
        "few_session_actions": query(
            f"""SELECT {ACTION_COLUMNS} FROM acts WHERE session_id IN (
  SELECT session_id FROM rolled ORDER BY md5(session_id), session_id LIMIT 100)"""
        ),
    }
