"""Equivalent DuckDB SQL for the deterministic registered queries.

Tables are the driver's pre-registered views. Column names, types and the
6-digit rounding match ``pickwise.plans.queries``. Model queries (ALS fits,
predictions, recommendations, grid) have no entry: they are checked by row
counts and by unit tests.
"""

from __future__ import annotations

R1 = """r1 AS (
  SELECT CAST(o.o_custkey AS INTEGER) AS userId,
         CAST(l.l_partkey AS INTEGER) AS productId,
         CAST(1 + floor((l.l_quantity - 1) / 10) AS DOUBLE) AS score,
         date_diff('second', TIMESTAMP '1970-01-01 00:00:00', l.l_shipdate) AS "timestamp"
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

R2RAW = """r2raw AS (
  SELECT event_id AS seq,
         CAST(user_id AS INTEGER) AS userId,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS productId,
         CAST(least(10.0, 1.0 + floor(value / 10)) AS DOUBLE) AS rawScore,
         date_diff('second', TIMESTAMP '1970-01-01 00:00:00', ts) AS "timestamp",
         ts, event_type
  FROM events)"""

R2 = R2RAW + """,
r2 AS (SELECT seq, userId, productId, round(rawScore / 2.0, 2) AS score, "timestamp", ts, event_type FROM r2raw)"""

PRODUCTS = """products AS (
  SELECT CAST(p_partkey AS INTEGER) AS productId, p_name AS name, '' AS imageUrl,
         p_type || '|' || p_brand AS categories,
         array_to_string(list_concat(string_split(p_name, ' '), [p_brand, p_type]), '|') AS tags
  FROM part)"""

YM = "CAST(year(date '1970-01-01' + CAST(floor({t} / 86400) AS INTEGER)) * 100 + " \
     "month(date '1970-01-01' + CAST(floor({t} / 86400) AS INTEGER)) AS INTEGER)"

AVG1 = """avg1 AS (SELECT productId, avg(score) AS avg FROM r1 GROUP BY productId)"""

ENRICHED = PRODUCTS + ",\n" + AVG1 + """,
enriched AS (SELECT p.*, coalesce(a.avg, 0.0) AS score_raw FROM products p LEFT JOIN avg1 a USING (productId))"""

ITEMCF = """ui AS (SELECT DISTINCT userId, productId FROM r2),
deg AS (SELECT productId, count(*) AS deg FROM ui GROUP BY productId),
co AS (SELECT a.productId AS p, b.productId AS q, count(*) AS cnt
       FROM ui a JOIN ui b ON a.userId = b.userId AND a.productId <> b.productId GROUP BY 1, 2),
sims AS (SELECT co.p AS productId, co.q AS simProductId,
                round(cnt / sqrt(CAST(dp.deg AS DOUBLE) * dq.deg), 10) AS score
         FROM co JOIN deg dp ON dp.productId = co.p JOIN deg dq ON dq.productId = co.q),
edges AS (SELECT * FROM sims WHERE score > 0.4)"""

SP = ITEMCF + """,
cur AS (SELECT userId, productId, score, "timestamp", seq FROM (
          SELECT *, row_number() OVER (PARTITION BY userId ORDER BY "timestamp" DESC, seq DESC) AS rn FROM r2)
        WHERE rn = 1),
rated AS (SELECT DISTINCT userId, productId FROM r2),
nbrs AS (SELECT c.userId, c.productId AS curProductId, e.simProductId AS productId, e.score AS sim
         FROM cur c JOIN edges e ON e.productId = c.productId),
unrated AS (SELECT n.userId, n.productId, n.sim FROM nbrs n
            WHERE NOT EXISTS (SELECT 1 FROM rated r WHERE r.userId = n.userId AND r.productId = n.productId)),
cand AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY userId ORDER BY sim DESC, productId) AS INTEGER)
                               AS candRank FROM unrated) WHERE candRank <= 20),
recent AS (SELECT userId, productId AS recentProductId, score AS recentScore FROM (
             SELECT *, row_number() OVER (PARTITION BY userId ORDER BY "timestamp" DESC, seq DESC) AS rn FROM r2)
           WHERE rn <= 21),
pairs AS (SELECT c.userId, c.productId, r.recentProductId, r.recentScore FROM cand c JOIN recent r USING (userId)),
hit AS (SELECT p.*, e.score AS sim FROM pairs p
        JOIN edges e ON e.productId = p.productId AND e.simProductId = p.recentProductId WHERE e.score > 0.4),
scored AS (SELECT userId, productId, avg(sim * recentScore) AS baseScore,
                  CAST(count_if(recentScore > 3) AS BIGINT) AS nHigh,
                  CAST(count_if(recentScore <= 3) AS BIGINT) AS nLow
           FROM hit GROUP BY userId, productId),
prio AS (SELECT *, baseScore + log10(greatest(nHigh, 1)) - log10(greatest(nLow, 1)) AS priority FROM scored)"""

USERS = """users AS (SELECT CAST(c_custkey AS INTEGER) AS userId, c_name AS username FROM customer)"""

LINES = """lines AS (
  SELECT seq, 'PRODUCT_RATING_PREFIX:' || CAST(userId AS VARCHAR) || '|' || CAST(productId AS VARCHAR) || '|'
              || CAST(score AS VARCHAR) || '|' || CAST("timestamp" AS VARCHAR) AS value FROM r2
  UNION ALL
  SELECT seq, CAST(userId AS VARCHAR) || '|' || CAST(productId AS VARCHAR) || '|x|' || CAST("timestamp" AS VARCHAR)
  FROM r2 WHERE event_type = 'error'
  UNION ALL
  SELECT seq, CAST(userId AS VARCHAR) || '|' || CAST(productId AS VARCHAR) || '|' || CAST(score AS VARCHAR)
  FROM r2 WHERE event_type = 'signup'),
parsed AS (
  SELECT seq, TRY_CAST(trim(a[1]) AS INTEGER) AS userId, TRY_CAST(trim(a[2]) AS INTEGER) AS productId,
         TRY_CAST(trim(a[3]) AS DOUBLE) AS score, TRY_CAST(trim(a[4]) AS BIGINT) AS "timestamp"
  FROM (SELECT seq, string_split(regexp_replace(value, '^.*PRODUCT_RATING_PREFIX:', ''), '|') AS a FROM lines)
  WHERE len(a) >= 4)"""

TOKENS = """toks AS (SELECT CAST(doc_id AS INTEGER) AS productId,
                 unnest(regexp_split_to_array(lower(text), '\\s+')) AS term FROM documents),
tf AS (SELECT productId, term, count(*) AS tf FROM toks WHERE term <> '' GROUP BY 1, 2),
dfreq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
ndocs AS (SELECT count(*) AS n FROM documents)"""

# Hashed TF-IDF (M7 hashed, M8). A term's bucket is HashingTF's: 32-bit murmur3
# (seed 42) over the term's UTF-8 bytes, little-endian 4-byte blocks, tail bytes
# mixed as one block, then the non-negative remainder mod 200. Arithmetic is on
# HUGEINT and reduced mod 2^32 after every step.
# Fixed values of the hash (murmur3 x86_32): c1 = 0xcc9e2d51 = 3432918353,
# c2 = 0x1b873593 = 461845907, n = 0xe6546b64 = 3864292196,
# f1 = 0x85ebca6b = 2246822507, f2 = 0xc2b2ae35 = 3266489909, seed 42, 200 buckets.
HASHED = TOKENS + """,
terms AS (SELECT DISTINCT term FROM tf),
tbytes AS (SELECT term, list_transform(range(octet_length(encode(term))),
             lambda i: CAST(CAST('0x' || substr(hex(encode(term)), 2 * i + 1, 2) AS INTEGER) AS HUGEINT)) AS b
           FROM terms),
tblocks AS (SELECT term, len(b) AS nbytes,
              list_transform(range(len(b) // 4),
                lambda j: b[4 * j + 1] | (b[4 * j + 2] << 8) | (b[4 * j + 3] << 16) | (b[4 * j + 4] << 24))
              || [coalesce(list_sum(list_transform(range(len(b) % 4),
                    lambda i: b[len(b) - len(b) % 4 + i + 1] << (8 * i))), CAST(0 AS HUGEINT))] AS k
            FROM tbytes),
tmixk AS (SELECT term, nbytes, list_transform(list_transform(list_transform(k,
            lambda x: (x * 3432918353) % 4294967296),
            lambda x: ((x << 15) | (x >> 17)) & 4294967295),
            lambda x: (x * 461845907) % 4294967296) AS k FROM tblocks),
tmixh AS (SELECT term, nbytes, xor(list_reduce(k[1:len(k) - 1],
            lambda h, x: ((((xor(h, x) << 13) | (xor(h, x) >> 19)) & 4294967295) * 5 + 3864292196) % 4294967296,
            CAST(42 AS HUGEINT)), k[len(k)]) AS h FROM tmixk),
tfmix1 AS (SELECT term, (xor(xor(h, nbytes), xor(h, nbytes) >> 16) * 2246822507) % 4294967296 AS h FROM tmixh),
tfmix2 AS (SELECT term, (xor(h, h >> 13) * 3266489909) % 4294967296 AS h FROM tfmix1),
tbucket AS (SELECT term, CAST(((CASE WHEN xor(h, h >> 16) >= 2147483648 THEN xor(h, h >> 16) - 4294967296
                                     ELSE xor(h, h >> 16) END) % 200 + 200) % 200 AS INTEGER) AS bucket
            FROM tfmix2),
htf AS (SELECT tf.productId, t.bucket, sum(tf.tf) AS htf FROM tf JOIN tbucket t USING (term) GROUP BY 1, 2),
hdf AS (SELECT bucket, count(*) AS df FROM htf GROUP BY bucket),
hw AS (SELECT h.productId, h.bucket, h.htf * ln((ndocs.n + 1.0) / (hdf.df + 1.0)) AS w
       FROM htf h JOIN hdf USING (bucket), ndocs),
hv AS (SELECT d.productId, list(coalesce(hw.w, 0.0) ORDER BY bk.i) AS f
       FROM (SELECT DISTINCT productId FROM htf) d CROSS JOIN range(200) bk(i)
       LEFT JOIN hw ON hw.productId = d.productId AND hw.bucket = bk.i GROUP BY d.productId),
hvn AS (SELECT productId, f, sqrt(list_dot_product(f, f)) AS nrm FROM hv),
hcs AS (SELECT a.productId, b.productId AS simProductId,
               round(list_dot_product(a.f, b.f) / (a.nrm * b.nrm), 10) AS score
        FROM hvn a JOIN hvn b ON a.productId <> b.productId WHERE a.nrm > 0 AND b.nrm > 0),
cedges AS (SELECT productId, simProductId, score,
             CAST(row_number() OVER (PARTITION BY productId ORDER BY score DESC, simProductId) AS INTEGER) AS rank
           FROM hcs WHERE score > 0.4)"""

# XXH64 as Spark's xxhash64(userId, productId, timestamp, score) computes it
# (M5 hash split): seed 42, each non-null column hashed with the previous hash
# as seed; INT columns take the 4-byte path, BIGINT and DOUBLE (its IEEE bits)
# the 8-byte path. Values are unsigned in [0, 2^64) as HUGEINT; a 64-bit
# product is split into 32-bit halves so it never leaves HUGEINT's range.
# Fixed values of XXH64: the five primes.
_M64 = "18446744073709551616"
_XX_P1, _XX_P2, _XX_P3, _XX_P4, _XX_P5 = (11400714785074694791, 14029467366897019727, 1609587929392839161,
                                          9650029242287828579, 2870177450012600261)


def _mul64(a: str, c: int) -> str:
    hi, lo = c >> 32, c & 0xFFFFFFFF
    return f"(({a}) * {lo} + ((({a}) * {hi}) % 4294967296) * 4294967296) % {_M64}::HUGEINT"


def _rotl64(a: str, r: int) -> str:
    return f"(((({a}) << {r}) | (({a}) >> {64 - r})) % {_M64}::HUGEINT)"


def _xx_column(prefix: str, src: str, val: str, width: int, out: str) -> list[str]:
    """CTEs folding one column into ``h`` (unchanged when the value is null)."""
    if width == 4:
        mix = f"xor((h + {_XX_P5} + 4) % {_M64}::HUGEINT, " \
              f"{_mul64(f'(CAST({val} AS HUGEINT) + 4294967296) % 4294967296', _XX_P1)})"
        step = f"({_mul64(_rotl64('h', 23), _XX_P2)} + {_XX_P3}) % {_M64}::HUGEINT"
    else:
        unsigned = f"(CAST({val} AS HUGEINT) + {_M64}::HUGEINT) % {_M64}::HUGEINT"
        mix = f"xor((h + {_XX_P5} + 8) % {_M64}::HUGEINT, {_mul64(_rotl64(_mul64(unsigned, _XX_P2), 31), _XX_P1)})"
        step = f"({_mul64(_rotl64('h', 27), _XX_P1)} + {_XX_P4}) % {_M64}::HUGEINT"
    stages = [mix, step, _mul64("xor(h, h >> 33)", _XX_P2), _mul64("xor(h, h >> 29)", _XX_P3), "xor(h, h >> 32)"]
    names = [f"{prefix}{i}" for i in range(len(stages) - 1)] + [out]
    froms = [src] + names[:-1]
    return [f"{n} AS (SELECT * REPLACE (CASE WHEN {val} IS NULL THEN h ELSE {e} END AS h) FROM {f})"
            for n, f, e in zip(names, froms, stages)]


_DOUBLE_BITS = """CASE WHEN score IS NULL THEN NULL WHEN score = 0 THEN CAST(0 AS HUGEINT) ELSE
    (CASE WHEN score < 0 THEN CAST(1 AS HUGEINT) << 63 ELSE CAST(0 AS HUGEINT) END)
    + (CAST(e + 1023 AS HUGEINT) << 52) + CAST((abs(score) / pow(2.0, e) - 1.0) * pow(2.0, 52) AS HUGEINT) END"""

# r2 rows with xh = xxhash64(userId, productId, timestamp, score); scores are normal doubles
XXSPLIT = ",\n".join([
    """x0 AS (SELECT seq, userId, productId, score, "timestamp", CAST(42 AS HUGEINT) AS h,
             CAST(floor(log2(abs(score))) AS INTEGER) AS e0 FROM r2)""",
    """x1 AS (SELECT * EXCLUDE (e0), CASE WHEN score IS NULL OR score = 0 THEN 0
             WHEN pow(2.0, e0) > abs(score) THEN e0 - 1 WHEN pow(2.0, e0 + 1) <= abs(score) THEN e0 + 1
             ELSE e0 END AS e FROM x0)""",
    f"x2 AS (SELECT * EXCLUDE (e), {_DOUBLE_BITS} AS sbits FROM x1)",
    *_xx_column("xu", "x2", "userId", 4, "xhu"),
    *_xx_column("xp", "xhu", "productId", 4, "xhp"),
    *_xx_column("xt", "xhp", '"timestamp"', 8, "xht"),
    *_xx_column("xs", "xht", "sbits", 8, "xhs"),
    f"""xsplit AS (SELECT *, CAST(CASE WHEN h >= 9223372036854775808 THEN h - {_M64}::HUGEINT ELSE h END AS BIGINT)
             AS xh FROM xhs)""",
])

COSINE = """v AS (SELECT CAST(vec_id AS INTEGER) AS productId, CAST(embedding AS DOUBLE[]) AS f FROM embeddings),
vn AS (SELECT productId, f, sqrt(list_sum(list_transform(f, lambda x: x * x))) AS nrm FROM v),
cs AS (SELECT a.productId, b.productId AS simProductId,
              list_sum(list_transform(list_zip(a.f, b.f), lambda z: z[1] * z[2])) / (a.nrm * b.nrm) AS cosv
       FROM vn a JOIN vn b ON a.productId <> b.productId WHERE a.nrm > 0 AND b.nrm > 0),
vedges AS (SELECT productId, simProductId, cosv AS score FROM cs WHERE round(cosv, 10) > 0.4)"""


def _w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLE: dict[str, str] = {
    "rate_more_products": _w(R1) + "SELECT productId, count(productId) AS \"count\" FROM r1 GROUP BY productId",
    "rate_more_recently_products": _w(R1) + f"""SELECT productId, count(productId) AS "count", yearmonth
        FROM (SELECT productId, {YM.format(t='"timestamp"')} AS yearmonth FROM r1) GROUP BY yearmonth, productId""",
    "average_products": _w(R1) + "SELECT productId, round(avg(score), 6) AS avg FROM r1 GROUP BY productId",
    "distinct_users": _w(R1) + "SELECT DISTINCT userId FROM r1",
    "distinct_products": _w(R1) + "SELECT DISTINCT productId FROM r1",
    "rating_month_projection": _w(R1) + f"SELECT productId, score, {YM.format(t='\"timestamp\"')} AS yearmonth FROM r1",
    "rating_triples": _w(R1) + "SELECT userId, productId, score FROM r1",
    "epoch_to_yearmonth": _w(R1) + f"SELECT DISTINCT \"timestamp\", {YM.format(t='\"timestamp\"')} AS yearmonth FROM r1",
    "rmse": _w(R1, AVG1) + """SELECT round(sqrt(avg((r.score - a.avg) * (r.score - a.avg))), 6) AS rmse
        FROM r1 r JOIN avg1 a USING (productId)""",
    "load_products": _w(PRODUCTS, """lines AS (
          SELECT CASE WHEN productId % 29 = 0 THEN '  ' WHEN productId % 23 = 0 THEN productId || '^' || name
                      ELSE CASE WHEN productId % 17 = 0 THEN 'x' ELSE '' END || productId || '^ ' || name || ' ^1,2^B00^'
                           || imageUrl || '^' || categories || '^' || tags END AS line FROM products),
        parts AS (SELECT line, string_split(line, '^') AS a, TRY_CAST(trim(string_split(line, '^')[1]) AS INTEGER) AS id
                  FROM lines)""") + """SELECT id AS productId,
            CASE WHEN id IS NOT NULL THEN trim(coalesce(a[2], '')) END AS name,
            CASE WHEN id IS NOT NULL THEN trim(coalesce(a[5], '')) END AS imageUrl,
            CASE WHEN id IS NOT NULL THEN trim(coalesce(a[6], '')) END AS categories,
            CASE WHEN id IS NOT NULL THEN trim(coalesce(a[7], '')) END AS tags,
            CASE WHEN id IS NULL THEN line END AS line,
            CASE WHEN id IS NULL THEN CASE WHEN trim(line) = '' THEN 'blank line' ELSE 'bad productId' END END AS reason
        FROM parts""",
    "load_ratings": _w(R2, """lines AS (
          SELECT userId || ',' || productId || ',' || CASE WHEN seq % 13 = 0 THEN 'x' WHEN seq % 31 = 0 THEN 'NaN'
                      ELSE CAST(score AS VARCHAR) END || CASE WHEN seq % 19 = 0 THEN ''
                      ELSE ',' || CASE WHEN seq % 7 = 0 THEN "timestamp" * 1000 + 123 ELSE "timestamp" END END AS line,
                 CASE WHEN seq % 19 = 0 THEN 'too few fields' WHEN seq % 13 = 0 OR seq % 31 = 0 THEN 'bad score' END AS reason,
                 userId, productId, score, "timestamp" FROM r2)""") + """SELECT
            CASE WHEN reason IS NULL THEN userId END AS userId, CASE WHEN reason IS NULL THEN productId END AS productId,
            CASE WHEN reason IS NULL THEN score END AS score, CASE WHEN reason IS NULL THEN "timestamp" END AS "timestamp",
            CASE WHEN reason IS NOT NULL THEN line END AS line, reason FROM lines""",
    "top_inner_products": """WITH v AS (SELECT CAST(vec_id AS INTEGER) AS id, CAST(embedding AS DOUBLE[]) AS f FROM embeddings),
        s AS (SELECT a.id AS userId, b.id AS productId, round(list_dot_product(a.f, b.f), 10) AS s
              FROM v a, v b WHERE a.id % 20 = 0)
        SELECT userId, CAST(rk AS INTEGER) AS rank, productId, round(s, 6) AS score
        FROM (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY s DESC, productId) AS rk FROM s WHERE s > 0)
        WHERE rk <= 20""",
    "search_products_by_index": _w(PRODUCTS, """patterns AS (SELECT unnest(['ring', '^s.*bolt$', 'red|gizmo', 'w[aeiou]dge',
            'colou?r', 'old', 'e{2}n', 'a.l']) AS pattern)""") + """SELECT pattern, productId, name
        FROM patterns, products WHERE regexp_matches(name, pattern)""",
    "als_normal_equations": _w(R2) + "SELECT userId, count(*) AS nRatings, TRUE AS solved FROM r2 GROUP BY userId",
    "als_factor_ranks": _w(R2) + "SELECT DISTINCT productId, CAST(1 AS BIGINT) AS vectors, CAST(5 AS INTEGER) AS rank FROM r2",
    "als_predictions_are_products": _w(R2) + """SELECT userId, productId, count(*) AS n, TRUE AS isProduct FROM r2
        GROUP BY userId, productId""",
    "user_recs_are_lists": _w(R2) + "SELECT DISTINCT userId, TRUE AS wellFormed FROM r2",
    "als_product_recs_are_cosines": _w(R2) + "SELECT DISTINCT productId, TRUE AS areCosines FROM r2",
    "grid_has_its_minimum": """SELECT CAST(r.r AS INTEGER) AS rank, CAST(l.l AS DOUBLE) AS lambda, TRUE AS ok
        FROM (VALUES (5), (10), (20), (50)) r(r), (VALUES (1.0), (0.1), (0.01)) l(l)""",
    "first_match": _w(R1) + """SELECT userId, productId, score, "timestamp" FROM (
            SELECT *, row_number() OVER (PARTITION BY userId ORDER BY "timestamp", productId, score) AS rn FROM r1)
        WHERE rn = 1""",
    "hot_products": _w(R1, ENRICHED) + f"""SELECT CAST(min(t.rk) AS INTEGER) AS rank, e.productId, e.name, e.imageUrl,
            e.categories, e.tags, round(e.score_raw, 6) AS score
        FROM (SELECT productId, row_number() OVER (ORDER BY yearmonth DESC, cnt DESC, productId) AS rk
              FROM (SELECT productId, yearmonth, count(*) AS cnt FROM
                      (SELECT productId, {YM.format(t='"timestamp"')} AS yearmonth FROM r1) GROUP BY 1, 2)
              ORDER BY yearmonth DESC, cnt DESC, productId LIMIT 100) t
        JOIN enriched e USING (productId)
        GROUP BY e.productId, e.name, e.imageUrl, e.categories, e.tags, e.score_raw""",
    "most_rated_products": _w(R1, ENRICHED) + """SELECT CAST(t.rk AS INTEGER) AS rank, e.productId, e.name, e.imageUrl,
            e.categories, e.tags, round(e.score_raw, 6) AS score
        FROM (SELECT productId, row_number() OVER (ORDER BY cnt DESC, productId) AS rk
              FROM (SELECT productId, count(*) AS cnt FROM r1 GROUP BY 1) ORDER BY cnt DESC, productId LIMIT 100) t
        JOIN enriched e USING (productId)""",
    "enrich_product_score": _w(R1, ENRICHED) + """SELECT productId, name, imageUrl, categories, tags,
        round(score_raw, 6) AS score FROM enriched""",
    "product_info": _w(R1, R2, ENRICHED) + """SELECT k.productId, e.name, e.imageUrl, e.categories, e.tags,
            round(e.score_raw, 6) AS score
        FROM (SELECT DISTINCT productId FROM r2) k LEFT JOIN enriched e USING (productId)""",
    "product_documents": _w(R1, ENRICHED) + """SELECT productId,
            CAST(to_json(struct_pack(productId := productId, name := name, imageUrl := imageUrl,
                 categories := categories, tags := tags, score := round(score_raw, 6))) AS VARCHAR) AS doc,
            name, round(score_raw, 6) AS score FROM enriched""",
    "search_products_by_name": _w(R1, ENRICHED) + """SELECT productId, name, imageUrl, categories, tags,
        round(score_raw, 6) AS score FROM enriched WHERE regexp_matches(name, 'ring')""",
    "normalise_rating_score": _w(R2RAW) + "SELECT seq, rawScore, round(rawScore / 2.0, 2) AS score FROM r2raw",
    "user_ratings": _w(R2) + "SELECT DISTINCT userId, productId FROM r2",
    "recent_ratings_k": _w(R2) + """SELECT * FROM (SELECT userId, productId, score, "timestamp", seq,
            CAST(row_number() OVER (PARTITION BY userId ORDER BY "timestamp" DESC, seq DESC) AS INTEGER) AS recency
        FROM r2) WHERE recency <= 21""",
    "latest_rating_upsert": _w(R2) + """SELECT userId, productId, arg_max(score, "timestamp" * 1000000000 + seq) AS score,
        min("timestamp") AS "timestamp" FROM r2 GROUP BY userId, productId""",
    "latest_event_per_user": _w(R2) + """SELECT userId, productId, score, "timestamp", seq FROM (
        SELECT *, row_number() OVER (PARTITION BY userId ORDER BY "timestamp" DESC, seq DESC) AS rn FROM r2)
        WHERE rn = 1""",
    "emit_rating_events": _w(R2) + """SELECT 'PRODUCT_RATING_PREFIX:' || CAST(userId AS VARCHAR) || '|' ||
        CAST(productId AS VARCHAR) || '|' || CAST(score AS VARCHAR) || '|' || CAST("timestamp" AS VARCHAR) AS value
        FROM r2""",
    "extract_rating_log": _w(R2) + """SELECT CAST(userId AS VARCHAR) || '|' || CAST(productId AS VARCHAR) || '|' ||
        CAST(score AS VARCHAR) || '|' || CAST("timestamp" AS VARCHAR) AS value FROM r2""",
    "parse_rating_events": _w(R2, LINES) + "SELECT * FROM parsed",
    "valid_event_filter": _w(R2, LINES) + """SELECT * FROM parsed WHERE userId IS NOT NULL AND productId IS NOT NULL
        AND score IS NOT NULL AND "timestamp" IS NOT NULL""",
    "username_to_user_id": """SELECT c_name AS username, CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END
            AS INTEGER) AS userId
        FROM (SELECT c_name, CASE WHEN length(c_name) = 0 THEN 0 ELSE
                list_reduce(list_transform(string_split(c_name, ''), lambda ch: CAST(unicode(ch) AS BIGINT)),
                            lambda acc, x: (acc * 31 + x) % 4294967296) END AS h FROM customer)""",
    "user_by_name": _w(R2, USERS) + """SELECT userId, username FROM users
        WHERE userId IN (SELECT DISTINCT userId FROM r2)""",
    "item_cf_recs": _w(R2, ITEMCF) + "SELECT productId, simProductId, round(score, 6) AS score FROM edges",
    "rank_similar_products": _w(R2, ITEMCF) + """SELECT productId, simProductId, round(score, 6) AS score,
        CAST(row_number() OVER (PARTITION BY productId ORDER BY score DESC, simProductId) AS INTEGER) AS rank FROM edges""",
    "collect_recs_per_key": _w(R2, ITEMCF) + """SELECT productId, CAST(count(*) AS INTEGER) AS nRecs,
        string_agg(CAST(simProductId AS VARCHAR), ',' ORDER BY score DESC, simProductId) AS recIds
        FROM edges GROUP BY productId""",
    "explode_recs": _w(R2, ITEMCF) + """SELECT productId AS queryProductId,
        CAST(row_number() OVER (PARTITION BY productId ORDER BY score DESC, simProductId) AS INTEGER) AS rank,
        simProductId AS productId, round(score, 6) AS score FROM edges""",
    "similarity_map": _w(R2, ITEMCF) + "SELECT productId, simProductId, round(score, 6) AS score FROM edges",
    "recs_to_products": _w(R2, ITEMCF, PRODUCTS) + """SELECT e.productId AS queryProductId,
        CAST(row_number() OVER (PARTITION BY e.productId ORDER BY e.score DESC, e.simProductId) AS INTEGER) AS rank,
        e.simProductId AS productId, p.name FROM edges e JOIN products p ON p.productId = e.simProductId""",
    "item_cf_products": _w(R1, R2, ITEMCF, ENRICHED) + """SELECT r.queryProductId, r.rank, r.productId, p.name,
            round(r.recScore, 6) AS recScore, round(p.score_raw, 6) AS score
        FROM (SELECT productId AS queryProductId, simProductId AS productId, score AS recScore,
                CAST(row_number() OVER (PARTITION BY productId ORDER BY score DESC, simProductId) AS INTEGER) AS rank
              FROM edges WHERE productId IN (SELECT productId FROM r2)) r
        JOIN enriched p USING (productId)""",
    "product_recs": _w(COSINE) + """SELECT productId, simProductId, round(score, 6) AS score,
        CAST(row_number() OVER (PARTITION BY productId ORDER BY score DESC, simProductId) AS INTEGER) AS rank FROM vedges""",
    "cosine_similarity": _w(COSINE) + "SELECT productId, simProductId, round(score, 6) AS score FROM vedges",
    "train_test_split": _w(R2, XXSPLIT) + """SELECT seq, userId, productId, score,
        CASE WHEN ((xh % 1000) + 1000) % 1000 < 800 THEN 'train' ELSE 'test' END AS split FROM xsplit""",
    # the 10-digit scores are rounded HALF_UP as decimals, as Spark's round does
    # (a binary-double round would send ...5000 ties down)
    "content_based_recs": _w(HASHED) + """SELECT productId, simProductId,
        CAST(round(CAST(score AS DECIMAL(18, 10)), 6) AS DOUBLE) AS score, rank FROM cedges""",
    "content_based_products": _w(R1, ENRICHED, HASHED) + """SELECT r.queryProductId, r.rank, r.productId, p.name,
            CAST(round(CAST(r.recScore AS DECIMAL(18, 10)), 6) AS DOUBLE) AS recScore,
            round(p.score_raw, 6) AS score
        FROM (SELECT productId AS queryProductId, simProductId AS productId, score AS recScore, rank
              FROM cedges) r
        JOIN enriched p USING (productId)""",
    "content_features": _w(TOKENS) + """SELECT tf.productId, tf.term, tf.tf,
            round(ln((ndocs.n + 1.0) / (dfreq.df + 1.0)), 6) AS idf,
            round(tf.tf * ln((ndocs.n + 1.0) / (dfreq.df + 1.0)), 6) AS weight
        FROM tf JOIN dfreq USING (term), ndocs""",
    "neighbour_lookup": _w(R2, SP) + """SELECT userId, curProductId, productId, round(sim, 6) AS sim FROM nbrs""",
    "exclude_rated_products": _w(R2, SP) + "SELECT userId, productId, round(sim, 6) AS sim FROM unrated",
    "top_k_candidates": _w(R2, SP) + "SELECT userId, productId, round(sim, 6) AS sim, candRank FROM cand",
    "candidate_recent_cross": _w(R2, SP) + "SELECT userId, productId, recentProductId, recentScore FROM pairs",
    "pair_similarity_lookup": _w(R2, SP) + """SELECT userId, productId, recentProductId, recentScore,
        round(sim, 6) AS sim FROM hit""",
    "weighted_base_score": _w(R2, SP) + "SELECT userId, productId, round(baseScore, 6) AS baseScore FROM prio",
    "boost_penalty_counts": _w(R2, SP) + "SELECT userId, productId, nHigh, nLow FROM prio",
    "stream_priority": _w(R2, SP) + "SELECT userId, productId, round(priority, 6) AS priority FROM prio",
    "sort_priority": _w(R2, SP) + """SELECT userId, productId, round(priority, 6) AS priority,
        CAST(row_number() OVER (PARTITION BY userId ORDER BY round(priority, 6) DESC, productId) AS INTEGER) AS rank
        FROM prio""",
    "recs_for_username": _w(R2, SP, USERS) + """SELECT u.username, u.userId, CAST(count(p.productId) AS INTEGER) AS nRecs
        FROM users u JOIN (SELECT DISTINCT userId FROM r2) a USING (userId) LEFT JOIN prio p USING (userId)
        GROUP BY u.username, u.userId""",
    "stream_products": _w(R1, R2, SP, USERS, ENRICHED) + """SELECT u.username,
            CAST(row_number() OVER (PARTITION BY p.userId ORDER BY p.priority DESC, p.productId) AS INTEGER) AS rank,
            p.productId, e.name, round(p.priority, 6) AS recScore, round(e.score_raw, 6) AS score
        FROM prio p JOIN users u USING (userId) JOIN enriched e ON e.productId = p.productId""",
    "top_k_per_user": _w(R1) + """SELECT userId, productId, round(score, 6) AS score, rank FROM (
        SELECT userId, productId, score,
          CAST(row_number() OVER (PARTITION BY userId ORDER BY score DESC, productId) AS INTEGER) AS rank
        FROM (SELECT userId, productId, avg(score) AS score FROM r1 GROUP BY 1, 2)) WHERE rank <= 20""",
    "register_users": _w(R2, USERS) + """SELECT CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INTEGER)
            AS userId, username, true AS first, CAST(1735689600 AS BIGINT) AS "timestamp"
        FROM (SELECT username, list_reduce(list_transform(string_split(username, ''), lambda ch: CAST(unicode(ch) AS BIGINT)),
                     lambda acc, x: (acc * 31 + x) % 4294967296) AS h
              FROM (SELECT DISTINCT username FROM users
                    WHERE username NOT IN (SELECT u.username FROM users u
                                           WHERE u.userId IN (SELECT DISTINCT userId FROM r2))))""",
    "rate_products": _w(R2, USERS) + """SELECT r.seq, r.userId, r.productId, r.score, r."timestamp",
        'PRODUCT_RATING_PREFIX:' || CAST(r.userId AS VARCHAR) || '|' || CAST(r.productId AS VARCHAR) || '|' ||
        CAST(r.score AS VARCHAR) || '|' || CAST(r."timestamp" AS VARCHAR) AS value
        FROM r2 r JOIN users u USING (userId)""",
}
