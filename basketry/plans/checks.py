"""SQL text that answers each query a second way, written against the supplied tables alone."""

from __future__ import annotations

MARKER = "PRODUCT_RATING_PREFIX:"

STARS = """
stars AS (
  SELECT o_custkey::INTEGER AS userId, l_partkey::INTEGER AS productId,
         ((l_quantity::INTEGER - 1) % 10 + 1)::INTEGER AS raw,
         (epoch_us(o_orderdate) // 1000000)::BIGINT AS timestamp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

R_ORDER = STARS + """,
r_order AS (
  SELECT userId, productId, round(raw / 2.0::DOUBLE, 2)::DOUBLE AS score, timestamp FROM stars
)"""

R_EVENT = """
ev AS (
  SELECT event_id, event_type, value, user_id::INTEGER AS userId,
         regexp_extract(props, '[0-9]+')::INTEGER AS productId,
         round((floor(value)::INTEGER % 10 + 1) / 2.0::DOUBLE, 2)::DOUBLE AS score,
         (epoch_us(ts) // 1000000)::BIGINT AS timestamp
  FROM events
),
r_event AS (
  SELECT userId, productId, score, timestamp FROM ev WHERE event_type <> 'error'
)"""

P_PART = """
product AS (
  SELECT p_partkey::INTEGER AS productId, p_name AS name, '' AS imageUrl, p_type AS categories,
         regexp_replace(p_name || ' ' || p_type || ' ' || p_brand, ' +', '|', 'g') AS tags
  FROM part
)"""

INFO = R_ORDER + "," + P_PART + """,
info AS (
  SELECT p.*, round(coalesce(a.avg, 0.0), 6)::DOUBLE AS score
  FROM product p
  LEFT JOIN (SELECT productId, avg(score) AS avg FROM r_order GROUP BY 1) a USING (productId)
)"""

MONTH = "(extract(year FROM m) * 100 + extract(month FROM m))::INTEGER"

LOG = R_EVENT + f""",
log AS (
  SELECT event_id, CASE
    WHEN event_type <> 'error' THEN 'INFO --- [http] web :  {MARKER}'
         || userId || '|' || productId || '|' || score::VARCHAR || '|' || timestamp
    WHEN value < 2 THEN 'INFO --- [http] web :  {MARKER}'
    WHEN value < 5 THEN 'INFO --- [http] web :  {MARKER}' || userId || '|' || productId
    WHEN value < 10 THEN 'INFO --- [http] web :  {MARKER}' || userId || '|' || productId || '|x|y'
    ELSE 'ERROR --- [http] user ' || userId END AS value
  FROM ev
),
message AS (
  SELECT value AS line, trim(string_split(value, '{MARKER}')[2]) AS value
  FROM log WHERE contains(value, '{MARKER}')
),
parsed AS (
  SELECT line, value,
         try_cast(string_split(value, '|')[1] AS INTEGER) AS userId,
         try_cast(string_split(value, '|')[2] AS INTEGER) AS productId,
         try_cast(string_split(value, '|')[3] AS DOUBLE) AS score,
         try_cast(string_split(value, '|')[4] AS BIGINT) AS timestamp
  FROM message
)"""

USABLE = "userId IS NOT NULL AND productId IS NOT NULL AND score IS NOT NULL AND timestamp IS NOT NULL"


def co_rating(source: str, threshold: float) -> str:
    """CTEs ``full_sim`` (all products), ``rep`` and ``sim`` (representatives) from a rating CTE."""
    return f""",
rated AS (SELECT DISTINCT userId, productId FROM {source}),
sig AS (SELECT productId, count(*) AS n, list(userId ORDER BY userId) AS raters FROM rated GROUP BY 1),
rep AS (SELECT productId, n, min(productId) OVER (PARTITION BY raters) AS sameAs,
               count(*) OVER (PARTITION BY raters) AS copies FROM sig),
full_sim AS (
  SELECT a, b, round(c / sqrt(x.n::DOUBLE * y.n::DOUBLE), 9) AS sim
  FROM (SELECT l.productId AS a, r.productId AS b, count(*)::DOUBLE AS c
        FROM rated l JOIN rated r ON l.userId = r.userId AND l.productId <> r.productId
        GROUP BY 1, 2)
  JOIN sig x ON a = x.productId JOIN sig y ON b = y.productId
  WHERE round(c / sqrt(x.n::DOUBLE * y.n::DOUBLE), 9) > {threshold}
),
sim AS (
  SELECT a, b, sim FROM full_sim
  JOIN rep x ON a = x.productId AND x.sameAs = a JOIN rep y ON b = y.productId AND y.sameAs = b
  UNION ALL
  SELECT productId, productId, 1.0 FROM rep WHERE sameAs = productId AND copies > 1
)"""


CO_RATED = R_EVENT + co_rating("r_event", 0.4)

VECTOR = """
vec AS (SELECT vec_id::INTEGER AS productId, embedding::DOUBLE[] AS v,
               min(vec_id) OVER (PARTITION BY embedding)::INTEGER AS sameAs,
               count(*) OVER (PARTITION BY embedding) AS copies FROM embeddings),
full_sim AS (
  SELECT * FROM (
    SELECT x.productId AS a, y.productId AS b,
           round(list_cosine_similarity(x.v, y.v), 9) AS sim, x.sameAs AS ra, y.sameAs AS rb
    FROM vec x JOIN vec y ON x.productId <> y.productId)
  WHERE sim > 0.4
),
sim AS (
  SELECT a, b, sim FROM full_sim WHERE a = ra AND b = rb
  UNION ALL SELECT productId, productId, 1.0 FROM vec WHERE productId = sameAs AND copies > 1
)"""

TAGGED = P_PART + """,
tagset AS (SELECT productId, list_sort(list_distinct(string_split(tags, '|'))) AS tags FROM product),
word AS (SELECT productId, unnest(tags) AS tag FROM tagset),
weight AS (
  SELECT tag, ln(((SELECT count(*) FROM product) + 1) / (count(*) + 1)::DOUBLE) AS w
  FROM word GROUP BY tag
),
weighted AS (SELECT productId, tag, w FROM word JOIN weight USING (tag) WHERE w > 0),
norm AS (SELECT productId, sum(w * w) AS n2 FROM weighted GROUP BY 1),
rep AS (SELECT productId, min(productId) OVER (PARTITION BY tags) AS sameAs,
               count(*) OVER (PARTITION BY tags) AS copies
        FROM tagset WHERE productId IN (SELECT productId FROM norm)),
full_sim AS (
  SELECT a, b, round(dot / sqrt(x.n2 * y.n2), 9) AS sim
  FROM (SELECT l.productId AS a, r.productId AS b, sum(l.w * r.w) AS dot
        FROM weighted l JOIN weighted r ON l.tag = r.tag AND l.productId <> r.productId
        GROUP BY 1, 2)
  JOIN norm x ON a = x.productId JOIN norm y ON b = y.productId
  WHERE round(dot / sqrt(x.n2 * y.n2), 9) > 0.4
),
sim AS (
  SELECT a, b, sim FROM full_sim
  JOIN rep x ON a = x.productId AND x.sameAs = a JOIN rep y ON b = y.productId AND y.sameAs = b
  UNION ALL
  SELECT productId, productId, 1.0 FROM rep WHERE sameAs = productId AND copies > 1
)"""

PAIRS = "SELECT a::INTEGER AS productId, b::INTEGER AS otherId, round(sim, 6) AS sim FROM sim WHERE a <> b"


def top_of(n: int) -> str:
    return f""",
top AS (
  SELECT a AS productId, b AS otherId, sim,
         row_number() OVER (PARTITION BY a ORDER BY sim DESC, b)::INTEGER AS rank
  FROM full_sim QUALIFY rank <= {n}
)"""


# Whole lists between classes.
WHOLE = """,
whole AS (
  SELECT a AS productId, b AS otherId, sim, row_number() OVER (PARTITION BY a ORDER BY sim DESC, b)::INTEGER AS rank
  FROM sim
)"""

TOP = "SELECT productId, rank, otherId, round(sim, 6) AS sim FROM top"

REALTIME = CO_RATED + """,
placed AS (
  SELECT *, row_number() OVER (PARTITION BY userId ORDER BY timestamp DESC, productId DESC, score DESC) AS pos
  FROM r_event
),
candidate AS (
  SELECT e.userId, s.b AS productId, s.sim,
         row_number() OVER (PARTITION BY e.userId ORDER BY s.sim DESC, s.b)::INTEGER AS rank
  FROM placed e JOIN full_sim s ON e.productId = s.a AND e.pos = 1
  WHERE NOT EXISTS (SELECT 1 FROM rated r WHERE r.userId = e.userId AND r.productId = s.b)
  QUALIFY rank <= 20
),
scored AS (
  SELECT c.userId, c.productId,
         avg(s.sim * p.score)
           + log10(greatest(count(*) FILTER (p.score > 3), 1))
           - log10(greatest(count(*) FILTER (p.score <= 3), 1)) AS score
  FROM candidate c
  JOIN placed p ON p.userId = c.userId AND p.pos <= 20
  JOIN full_sim s ON s.a = c.productId AND s.b = p.productId
  GROUP BY 1, 2
),
listed AS (
  SELECT userId, productId, score,
         row_number() OVER (PARTITION BY userId ORDER BY score DESC, productId)::INTEGER AS rank
  FROM scored
)"""

UPSERT = R_ORDER + "," + R_EVENT + """,
every AS (SELECT *, 0 AS step FROM r_order UNION ALL SELECT *, 1 FROM r_event)
SELECT userId, productId,
       arg_max(score, (timestamp, step, score)) AS score, {when}(timestamp) AS timestamp
FROM every GROUP BY 1, 2"""

JAVA_HASH = """(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END)::INTEGER"""


def hashed(column: str) -> str:
    units = f"list_transform(string_split({column}, ''), lambda ch: ord(ch)::BIGINT)"
    return f"list_reduce(list_prepend(0::BIGINT, {units}), lambda h, u: (h * 31 + u) % 4294967296)"


SPLIT = R_EVENT + """,
split AS (
  SELECT *, CASE WHEN ('0x' || substr(md5(userId || '|' || productId || '|' || timestamp || '|0'), 1, 8))::BIGINT
                 / 4294967296.0::DOUBLE < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS part
  FROM r_event
)"""

MONTHLY = """,
monthly AS (
  SELECT productId, count(*) AS "count", yearMonth FROM (
    SELECT productId, (extract(year FROM m) * 100 + extract(month FROM m))::INTEGER AS yearMonth
    FROM (SELECT productId, make_timestamp(timestamp * 1000000) AS m FROM r_order)
  ) GROUP BY yearMonth, productId
)"""

CHECKS: dict[str, str] = {
    "rating_scan": f"WITH {R_ORDER} SELECT userId, productId, score FROM r_order",
    "rating_file_scan": f"WITH {R_ORDER} SELECT * FROM r_order",
    "product_scan": f"""WITH {P_PART}
        SELECT productId, name, 'http://img/' || productId AS imageUrl, categories, tags FROM product""",
    "rating_normalise": f"""WITH {STARS}
        SELECT userId, productId, raw, round(raw / 2.0::DOUBLE, 2)::DOUBLE AS score FROM stars""",
    "rating_year_month": f"""WITH {R_ORDER}
        SELECT productId, score, {MONTH} AS yearMonth
        FROM (SELECT *, make_timestamp(timestamp * 1000000) AS m FROM r_order)""",
    "sink_roundtrip": f"WITH {R_ORDER} SELECT * FROM r_order",
    "rate_more": f"""WITH {R_ORDER}
        SELECT productId, count(*) AS "count" FROM r_order GROUP BY 1 ORDER BY 2 DESC, 1""",
    "rate_more_recently": f"""WITH {R_ORDER} {MONTHLY}
        SELECT productId, "count", yearMonth FROM monthly ORDER BY 3 DESC, 2 DESC, 1""",
    "average_score": f"""WITH {R_ORDER}
        SELECT productId, round(avg(score), 6) AS avg FROM r_order GROUP BY 1 ORDER BY 2 DESC, 1""",
    "distinct_entities": f"""WITH {R_ORDER}
        SELECT DISTINCT 'user' AS kind, userId AS id FROM r_order
        UNION ALL SELECT DISTINCT 'product', productId FROM r_order""",
    "product_info": f"WITH {INFO} SELECT * FROM info",
    "product_search": f"WITH {INFO} SELECT * FROM info WHERE regexp_matches(name, 'widget|ring')",
    "serve_hot": f"""WITH {INFO} {MONTHLY},
        first AS (SELECT *, row_number() OVER (ORDER BY yearMonth DESC, "count" DESC, productId)::INTEGER AS pos
                  FROM monthly QUALIFY pos <= 20)
        SELECT rank, info.* FROM (SELECT productId, min(pos) AS rank FROM first GROUP BY 1)
        JOIN info USING (productId)""",
    "serve_rate_more": f"""WITH {INFO},
        c AS (SELECT productId, row_number() OVER (ORDER BY count(*) DESC, productId)::INTEGER AS rank
              FROM r_order GROUP BY productId QUALIFY rank <= 20)
        SELECT rank, info.* FROM c JOIN info USING (productId)""",
    "recs_to_products": f"""WITH {STARS}, {INFO.replace(STARS + ",", "")}, {TAGGED.replace(P_PART + ",", "")} {WHOLE}
        SELECT w.productId AS forProduct, w.rank, info.*
        FROM whole w JOIN rep ON rep.sameAs = w.otherId JOIN info ON info.productId = rep.productId
        WHERE w.productId <> info.productId""",
    "hot_entries": f"""WITH {R_ORDER} {MONTHLY},
        first AS (SELECT *, row_number() OVER (ORDER BY yearMonth DESC, "count" DESC, productId)::INTEGER AS pos
                  FROM monthly QUALIFY pos <= 20)
        SELECT min(pos) AS rank, productId, 0.0::DOUBLE AS score FROM first GROUP BY productId""",
    "point_read": f"WITH {P_PART} SELECT * FROM product ORDER BY productId DESC LIMIT 1",
    "id_list_read": f"""WITH {STARS}, {R_ORDER.replace(STARS + ",", "")}, {P_PART}
        SELECT * FROM product WHERE productId IN (
          SELECT productId FROM r_order GROUP BY 1 ORDER BY count(*) DESC, productId LIMIT 20)""",
    "serve_user_recs": f"""WITH {INFO}, {REALTIME}
        SELECT c_name AS username, userId, rank, productId, name, info.score
        FROM listed JOIN customer ON c_custkey = userId JOIN info USING (productId)
        WHERE rank <= 6""",
    "rating_from_web": f"WITH {R_ORDER} SELECT * FROM r_order",
    "rating_upsert": "WITH " + UPSERT.replace("{when}", "max"),
    "rating_upsert_keep_time": "WITH " + UPSERT.replace("{when}", "min"),
    "user_register": f"""
        SELECT {JAVA_HASH} AS userId, username, true AS first, 1556436808000::BIGINT AS timestamp
        FROM (SELECT DISTINCT s_name AS username, {hashed("s_name")} AS h FROM supplier
              WHERE s_name NOT IN (SELECT c_name FROM customer))""",
    "user_update": f"""
        SELECT {JAVA_HASH} AS userId, c_name AS username, NOT active AS first, 0::BIGINT AS timestamp,
               CASE WHEN active THEN c_mktsegment ELSE '' END AS prefGenres
        FROM (SELECT *, {hashed("c_name")} AS h,
                     c_custkey IN (SELECT o_custkey FROM orders) AS active FROM customer)""",
    "user_recent_ratings": f"""WITH {R_EVENT}
        SELECT *, row_number() OVER (PARTITION BY userId
                  ORDER BY timestamp DESC, productId DESC, score DESC)::INTEGER AS position
        FROM r_event QUALIFY position <= 20""",
    "train_test_split": f"WITH {SPLIT} SELECT * FROM split",
    "log_format": f"""WITH {R_EVENT}
        SELECT '{MARKER}' || userId || '|' || productId || '|' || score::VARCHAR || '|' || timestamp AS line
        FROM r_event""",
    "log_parse": f"WITH {LOG} SELECT userId, productId, score, timestamp FROM parsed WHERE {USABLE}",
    "log_quarantine": f"WITH {LOG} SELECT line AS value FROM parsed WHERE NOT ({USABLE})",
    "tag_explode": f"WITH {P_PART} SELECT productId, unnest(string_split(tags, '|')) AS tag FROM product",
    "product_similarity": f"WITH {VECTOR} {PAIRS}",
    "product_similarity_members": f"WITH {VECTOR} SELECT productId, sameAs FROM vec",
    "product_recs": f"WITH {VECTOR} {top_of(20)} {TOP}",
    "item_cf": f"WITH {CO_RATED} {PAIRS}",
    "item_cf_orders": f"WITH {R_ORDER} {co_rating('r_order', 0.1)} {PAIRS}",
    "item_cf_recs": f"WITH {CO_RATED} {top_of(20)} {TOP}",
    "content_based": f"WITH {TAGGED} {PAIRS}",
    "content_based_members": f"WITH {TAGGED} SELECT productId, sameAs FROM rep",
    "content_based_recs": f"WITH {TAGGED} {top_of(20)} {TOP}",
    "item_cf_members": f"WITH {CO_RATED} SELECT productId, sameAs FROM rep",
    "sim_map": f"""WITH {CO_RATED} {WHOLE}
        SELECT productId, (count(*) OVER (PARTITION BY productId))::INTEGER AS listed, otherId,
               round(sim, 6) AS sim, 0.0::DOUBLE AS unknown FROM whole""",
    "sim_lookup": f"""WITH {CO_RATED},
        asked AS (SELECT DISTINCT productId, otherId FROM (
          SELECT productId, lag(productId) OVER (PARTITION BY userId ORDER BY timestamp, productId, score) AS otherId
          FROM r_event) WHERE otherId IS NOT NULL)
        SELECT productId, otherId, round(coalesce(sim, 0.0), 6)::DOUBLE AS sim
        FROM asked LEFT JOIN full_sim ON a = productId AND b = otherId""",
    "candidate_products": f"""WITH {REALTIME}
        SELECT userId, rank, productId, round(sim, 6) AS sim FROM candidate""",
    "stream_recs": f"""WITH {REALTIME}
        SELECT u.userId, l.rank, l.productId, round(l.score, 6) AS score
        FROM (SELECT DISTINCT userId FROM r_event) u LEFT JOIN listed l USING (userId)""",
    "rmse_eval": f"""WITH {SPLIT},
        mean AS (SELECT productId, avg(score) AS prediction FROM split WHERE part = 'train' GROUP BY 1)
        SELECT round(sqrt(avg((score - prediction) * (score - prediction))), 6) AS rmse
        FROM split JOIN mean USING (productId) WHERE part = 'test'""",
    "als_factor_shape": f"""WITH {R_ORDER}
        SELECT DISTINCT 'user' AS kind, userId AS id, 100::INTEGER AS dims, true AS finite FROM r_order
        UNION ALL SELECT DISTINCT 'product', productId, 100::INTEGER, true FROM r_order""",
    "als_residuals": f"""WITH {R_ORDER}
        SELECT userId, count(DISTINCT productId) AS n, true AS solved FROM r_order GROUP BY userId""",
    "factor_user_recs": """
        SELECT x.vec_id::INTEGER AS userId,
               row_number() OVER (PARTITION BY x.vec_id ORDER BY d DESC, y_id)::INTEGER AS rank,
               y_id::INTEGER AS productId, d AS score
        FROM (SELECT x.vec_id, y.vec_id AS y_id,
                     round(list_dot_product(x.embedding::DOUBLE[], y.embedding::DOUBLE[]), 9) AS d
              FROM embeddings x, embeddings y) x
        WHERE d > 0 QUALIFY rank <= 20""",
    "factor_predict": f"""WITH {R_EVENT},
        pair AS (SELECT DISTINCT userId, productId FROM r_event)
        SELECT userId, productId, round(list_dot_product(x.embedding::DOUBLE[], y.embedding::DOUBLE[]), 6) AS prediction
        FROM pair JOIN embeddings x ON x.vec_id = userId JOIN embeddings y ON y.vec_id = productId""",
    "factor_rmse": f"""WITH {R_EVENT}
        SELECT round(sqrt(avg(pow(score - list_dot_product(x.embedding::DOUBLE[], y.embedding::DOUBLE[]), 2))), 6) AS rmse
        FROM r_event JOIN embeddings x ON x.vec_id = userId JOIN embeddings y ON y.vec_id = productId""",
    "factor_grid": f"""WITH {R_EVENT},
        point AS (
          SELECT rank, round(sqrt(avg(pow(score - list_dot_product(
                   (x.embedding::DOUBLE[])[1:rank], (y.embedding::DOUBLE[])[1:rank]), 2))), 6) AS rmse
          FROM r_event JOIN embeddings x ON x.vec_id = userId JOIN embeddings y ON y.vec_id = productId,
               (SELECT unnest([8, 16, 32, 64])::INTEGER AS rank) GROUP BY rank)
        SELECT rank, rmse, rank = (SELECT arg_min(rank, rmse) FROM point) AS best FROM point""",
    "stream_log_filter": f"WITH {LOG} SELECT 'logProcessor' AS key, value FROM message WHERE value <> ''",
    "stream_rating_parse": f"WITH {LOG} SELECT userId, productId, score, timestamp FROM parsed WHERE {USABLE}",
    "stream_restart": f"WITH {LOG} SELECT userId, productId, score, timestamp FROM parsed WHERE {USABLE}",
    "stream_daily": f"""WITH {R_EVENT}
        SELECT timestamp // 86400 * 86400 AS day, count(*) AS ratings, sum(score) AS scores FROM r_event
        GROUP BY 1 HAVING day + 86400 <= (SELECT max(timestamp) FROM r_event) - 7200""",
    "sink_overwrite": f"WITH {R_EVENT} SELECT * FROM r_event",
    "stream_similar": f"""WITH {CO_RATED} {WHOLE}
        SELECT e.userId, e.productId, e.timestamp, (w.rank - 1)::INTEGER AS pos, w.otherId, round(w.sim, 6) AS sim
        FROM r_event e JOIN rep USING (productId) LEFT JOIN whole w ON w.productId = rep.sameAs""",
    "stream_user_recents": f"""WITH {R_EVENT}
        SELECT userId, row_number() OVER (PARTITION BY userId
                  ORDER BY timestamp DESC, productId DESC, score DESC)::INTEGER AS position,
               productId, score, timestamp
        FROM r_event QUALIFY position <= 40""",
}
CHECKS["stream_rescore"] = CHECKS["stream_recs"]
CHECKS["indexed_recs"] = CHECKS["stream_recs"]
CHECKS["stream_follow_log"] = CHECKS["stream_recs"]
CHECKS["similarity_index"] = f"""WITH {CO_RATED},
    listed AS (SELECT a, b, sim, copies AS size FROM sim JOIN rep ON b = productId)
    SELECT a AS productId, (row_number() OVER (PARTITION BY a ORDER BY sim DESC, b))::INTEGER AS rank,
           coalesce(sum(size) OVER (PARTITION BY a ORDER BY sim DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
             - sum(size) OVER (PARTITION BY a, sim), 0)::BIGINT AS ahead,
           b AS otherId, size::BIGINT AS size, round(sim, 6) AS sim
    FROM listed"""
CHECKS["rating_merge_rows"] = CHECKS["rating_upsert"]
CHECKS["rating_merge"] = f"""SELECT productId, round(avg(score), 6) AS avg
    FROM ({CHECKS["rating_upsert"]}) GROUP BY productId"""
CHECKS["item_cf_orders_members"] = f"WITH {R_ORDER + co_rating('r_order', 0.1)} SELECT productId, sameAs FROM rep"
CHECKS["product_read"] = f"""WITH {R_ORDER}
    SELECT * FROM r_order WHERE productId =
        (SELECT productId FROM r_order GROUP BY productId ORDER BY count(*) DESC, productId LIMIT 1)"""
CHECKS["hot_products"] = f"""WITH {R_EVENT}
    SELECT productId, ceil(count(*) * 200 / (SELECT count(*) FROM r_event)::DOUBLE)::INTEGER AS salts
    FROM r_event GROUP BY productId HAVING count(*) * 1000 >= (SELECT count(*) FROM r_event)"""
