"""The same queries as SQL text over the shared tables."""

from __future__ import annotations

# Common table expressions: name -> (definition, names it builds on).
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "lines": (
        """SELECT o_custkey * 4 AS customer, l_suppkey * 4 + 1 AS supplier,
                  l_partkey * 4 + 2 AS part, l_returnflag = 'R' AS returned
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        (),
    ),
    "citizens": (
        """SELECT c_custkey * 4 AS citizen, CAST(c_nationkey AS BIGINT) * 4 + 3 AS nation
           FROM customer
           UNION ALL
           SELECT s_suppkey * 4 + 1, CAST(s_nationkey AS BIGINT) * 4 + 3 FROM supplier""",
        (),
    ),
    "arcs": (
        """SELECT customer AS user_id, supplier AS friend_id FROM lines
           UNION ALL SELECT customer, part FROM lines
           UNION ALL SELECT supplier, customer FROM lines WHERE NOT returned
           UNION ALL SELECT supplier, part FROM lines
           UNION ALL SELECT part, customer FROM lines
           UNION ALL SELECT part, supplier FROM lines
           UNION ALL SELECT citizen, nation FROM citizens
           UNION ALL SELECT nation, citizen FROM citizens""",
        ("lines", "citizens"),
    ),
    "edges": ("SELECT DISTINCT user_id, friend_id FROM arcs", ("arcs",)),
    "lists": (
        """SELECT customer AS user_id, supplier || ',' || part AS friends, 2 AS n FROM lines
           UNION ALL
           SELECT supplier, CASE WHEN returned THEN '' ELSE customer || ',' END || part,
                  CASE WHEN returned THEN 1 ELSE 2 END FROM lines
           UNION ALL SELECT part, customer || ',' || supplier, 2 FROM lines
           UNION ALL SELECT citizen, CAST(nation AS VARCHAR), 1 FROM citizens
           UNION ALL SELECT nation, CAST(citizen AS VARCHAR), 1 FROM citizens""",
        ("lines", "citizens"),
    ),
    "pairs": (
        """SELECT least(user_id, friend_id) AS a, greatest(user_id, friend_id) AS b,
                  bit_or(CASE WHEN user_id < friend_id THEN 1 ELSE 2 END) AS listing
           FROM edges GROUP BY 1, 2""",
        ("edges",),
    ),
    "mutual": (
        """SELECT p.a, p.b, x.friend_id
           FROM pairs p
           JOIN edges x ON x.user_id = p.a
           JOIN edges y ON y.user_id = p.b AND y.friend_id = x.friend_id
           WHERE p.listing = 3""",
        ("pairs", "edges"),
    ),
    "counts": (
        """SELECT p.a, p.b, coalesce(w.n, 0) AS n
           FROM pairs p
           LEFT JOIN (SELECT a, b, count(*) AS n FROM mutual GROUP BY a, b) w
             ON p.a = w.a AND p.b = w.b""",
        ("pairs", "mutual"),
    ),
    "top_pairs": (
        "SELECT a, b, n FROM counts ORDER BY n DESC, a, b LIMIT 10",
        ("counts",),
    ),
    "mutual_lists": (
        """SELECT p.a, p.b, coalesce(w.ids, '') AS mutual_friends
           FROM pairs p
           LEFT JOIN (SELECT a, b, string_agg(friend_id, ', ' ORDER BY friend_id) AS ids
                      FROM mutual GROUP BY a, b) w
             ON p.a = w.a AND p.b = w.b""",
        ("pairs", "mutual"),
    ),
    "asked": (
        """SELECT DISTINCT least(customer, other) AS a, greatest(customer, other) AS b
           FROM (SELECT customer, supplier AS other FROM lines WHERE returned
                 UNION ALL
                 SELECT customer, supplier + 1 FROM lines WHERE returned) t
           WHERE customer <> other""",
        ("lines",),
    ),
    "people": (
        """SELECT c_custkey * 4 AS user_id, c_mktsegment AS first_name,
                  c_name AS last_name, c_nationkey AS nationkey, c_acctbal AS acctbal
           FROM customer
           UNION ALL
           SELECT s_suppkey * 4 + 1, 'SUPPLIER', s_name, s_nationkey, s_acctbal
           FROM supplier""",
        (),
    ),
    "profiles": (
        """SELECT user_id, first_name, last_name, 'Addr ' || user_id AS address,
                  n_name AS city, r_name AS state, born,
                  strftime(born, '%m/%d/%Y') AS dob,
                  CAST((20241231 - CAST(strftime(born, '%Y%m%d') AS INTEGER)) // 10000
                       AS INTEGER) AS age
           FROM (SELECT *, CAST(DATE '1940-01-01'
                               + CAST(floor((acctbal + 1000) * 2) AS INTEGER) AS DATE) AS born
                 FROM people) p
           JOIN nation ON nationkey = n_nationkey
           JOIN region ON n_regionkey = r_regionkey""",
        ("people",),
    ),
    "reviews": (
        """SELECT l_orderkey * 100 + l_linenumber AS review_id, o_custkey AS user_id,
                  l_partkey AS business_id,
                  CASE WHEN l_tax = 0 THEN 'x' ELSE CAST(l_quantity AS VARCHAR) END AS stars
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        (),
    ),
    "businesses": (
        """SELECT p_partkey AS business_id, p_name AS full_address, p_type AS categories
           FROM part
           UNION ALL SELECT p_partkey, p_name, p_type FROM part WHERE p_size > 25""",
        (),
    ),
    "rated": (
        """SELECT business_id, avg(CAST(TRY_CAST(stars AS FLOAT) AS DOUBLE)) AS avg_stars
           FROM reviews GROUP BY business_id""",
        ("reviews",),
    ),
    "top_rated": (
        """SELECT business_id, avg_stars FROM rated
           ORDER BY avg_stars DESC NULLS LAST, business_id LIMIT 10""",
        ("rated",),
    ),
    "listed_top": (
        """SELECT t.business_id, full_address, categories, avg_stars
           FROM top_rated t JOIN businesses b ON t.business_id = b.business_id""",
        ("top_rated", "businesses"),
    ),
    "in_place": (
        """SELECT r.user_id, r.stars
           FROM reviews r JOIN businesses b ON r.business_id = b.business_id
           WHERE contains(b.full_address, 'ring')""",
        ("reviews", "businesses"),
    ),
    "friend_ages": (
        """SELECT e.user_id, e.friend_id, p.age
           FROM edges e LEFT JOIN profiles p ON e.friend_id = p.user_id""",
        ("edges", "profiles"),
    ),
    "max_ages": (
        """SELECT user_id, greatest(0, coalesce(max(age), 0)) AS max_age
           FROM friend_ages GROUP BY user_id""",
        ("friend_ages",),
    ),
    "top_ages": (
        "SELECT user_id, max_age FROM max_ages ORDER BY max_age DESC, user_id LIMIT 10",
        ("max_ages",),
    ),
    "common": (
        """SELECT friend_id FROM edges WHERE user_id IN (5, 9)
           GROUP BY friend_id HAVING count(DISTINCT user_id) = 2""",
        ("edges",),
    ),
    "common_text": (
        """SELECT '[' || coalesce(string_agg(label, ', ' ORDER BY label), '') || ']' AS friends
           FROM (SELECT coalesce(first_name || ': ' || dob, CAST(c.friend_id AS VARCHAR)) AS label
                 FROM common c LEFT JOIN profiles p ON c.friend_id = p.user_id) t""",
        ("common", "profiles"),
    ),
}


def _sql(view: str, body: str | None = None, *more: str) -> str:
    """`body`, or all of `view`, after the expressions that they need."""
    needed: list[str] = []

    def visit(name: str) -> None:
        for other in VIEWS[name][1]:
            visit(other)
        if name not in needed:
            needed.append(name)

    for name in (view, *more):
        visit(name)
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({VIEWS[n][0]})" for n in needed)
    return f"WITH {ctes}\n{body or f'SELECT * FROM {view}'}"


ORACLE: dict[str, str] = {
    "src_text_lines": _sql(
        "lists", "SELECT user_id || chr(9) || friends AS value FROM lists"
    ),
    "src_adjacency_list": _sql("edges"),
    "src_profiles": _sql(
        "profiles",
        """SELECT user_id, first_name, last_name, address, city, state,
                  'zip' AS field_6, 'country' AS field_7, 'login' AS field_8, dob
           FROM profiles""",
    ),
    "src_reviews": _sql(
        "reviews",
        """SELECT CAST(review_id AS VARCHAR) AS review_id, CAST(user_id AS VARCHAR) AS user_id,
                  CAST(business_id AS VARCHAR) AS business_id, stars FROM reviews""",
    ),
    "src_businesses": _sql(
        "businesses",
        """SELECT CAST(business_id AS VARCHAR) AS business_id, full_address, categories
           FROM businesses""",
    ),
    "sink_tab_text": _sql(
        "profiles",
        """SELECT concat_ws(chr(9), user_id, first_name, last_name, address, city, state, dob)
                  AS value
           FROM profiles""",
    ),
    "sink_single_text": _sql(
        "top_ages", "SELECT user_id || chr(9) || max_age AS value FROM top_ages"
    ),
    "sink_csv_header": _sql("in_place"),
    "proj_rename": _sql("reviews"),
    "proj_select": _sql("reviews", "SELECT user_id, stars FROM reviews"),
    "proj_explode_friends": _sql("arcs"),
    "proj_canonical_pairs": _sql("pairs"),
    "proj_profile_labels": _sql(
        "profiles",
        """SELECT user_id, first_name || ': ' || dob AS person,
                  address || ', ' || city || ', ' || state AS place,
                  first_name || chr(9) || last_name || chr(9) || address AS card
           FROM profiles""",
    ),
    "filter_well_formed": """
        SELECT CAST(c_custkey AS VARCHAR) AS user_text,
               CAST(c_nationkey AS VARCHAR) AS friends_text
        FROM customer WHERE c_acctbal >= 0""",
    "filter_pair_set": _sql(
        "pairs",
        """SELECT p.a, p.b, p.listing FROM pairs p
           JOIN asked q ON p.a = q.a AND p.b = q.b""",
        "asked",
    ),
    "filter_user_in": _sql("edges", "SELECT * FROM edges WHERE user_id IN (5, 9)"),
    "filter_contains": _sql(
        "businesses", "SELECT * FROM businesses WHERE contains(full_address, 'ring')"
    ),
    "having_count": _sql("common"),
    "join_pair_adjacency": _sql(
        "mutual",
        "SELECT m.* FROM mutual m JOIN asked q ON m.a = q.a AND m.b = q.b",
        "asked",
    ),
    "join_friend_profile": _sql(
        "edges",
        """SELECT e.user_id, e.friend_id, p.first_name || ': ' || p.dob AS label
           FROM edges e LEFT JOIN profiles p ON e.friend_id = p.user_id""",
        "profiles",
    ),
    "join_friend_age": _sql("friend_ages"),
    "join_user_address": _sql(
        "top_ages",
        """SELECT t.user_id, t.max_age, p.address, p.city, p.state
           FROM top_ages t LEFT JOIN profiles p ON t.user_id = p.user_id""",
        "profiles",
    ),
    "join_pair_profiles": _sql(
        "top_pairs",
        """SELECT t.a, t.b, t.n,
                  x.first_name AS a_first, x.last_name AS a_last, x.address AS a_address,
                  y.first_name AS b_first, y.last_name AS b_last, y.address AS b_address
           FROM top_pairs t
           LEFT JOIN profiles x ON t.a = x.user_id
           LEFT JOIN profiles y ON t.b = y.user_id""",
        "profiles",
    ),
    "join_after_topk": _sql("listed_top"),
    "agg_mutual_list": _sql("mutual_lists"),
    "agg_friend_arrivals": _sql(
        "edges", "SELECT friend_id, count(*) AS arrivals FROM edges GROUP BY friend_id"
    ),
    "agg_bracket_list": _sql("common_text"),
    "agg_max_friend_age": _sql("max_ages"),
    "agg_avg_stars": _sql("rated"),
    "topk_avg_stars": _sql("top_rated"),
    "topk_max_age": _sql("top_ages"),
    "set_array_intersect": _sql(
        "edges",
        """SELECT q.a, q.b, string_agg(x.friend_id, ', ' ORDER BY x.friend_id) AS common
           FROM asked q
           JOIN edges x ON x.user_id = q.a
           JOIN edges y ON y.user_id = q.b AND y.friend_id = x.friend_id
           GROUP BY q.a, q.b""",
        "asked",
    ),
    "fn_split": _sql(
        "reviews",
        """SELECT CAST(review_id AS VARCHAR) AS review_id, CAST(user_id AS VARCHAR) AS user_id,
                  CAST(business_id AS VARCHAR) AS business_id, stars,
                  CAST(4 AS BIGINT) AS n_fields
           FROM reviews""",
    ),
    "fn_to_integer": """
        SELECT c_custkey, TRY_CAST(split_part(c_name, '#', 1) AS BIGINT) AS word,
               TRY_CAST(split_part(c_name, '#', 2) AS BIGINT) AS number
        FROM customer""",
    "fn_to_float": _sql(
        "reviews", "SELECT review_id, TRY_CAST(stars AS FLOAT) AS stars FROM reviews"
    ),
    "fn_least_greatest": _sql(
        "arcs",
        """SELECT user_id, friend_id, least(user_id, friend_id) AS a,
                  greatest(user_id, friend_id) AS b
           FROM arcs""",
    ),
    "fn_parse_dob": _sql("profiles", "SELECT user_id, dob, born FROM profiles"),
    "fn_yyyymmdd": """
        SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS day
        FROM orders""",
    "fn_age_years": _sql("profiles", "SELECT user_id, age FROM profiles"),
    "fn_concat": _sql(
        "profiles",
        """SELECT user_id,
                  address || ', ' || city || ', ' || state || ', ' || age AS line
           FROM profiles""",
    ),
    "fn_list_size": _sql("lists", "SELECT user_id, CAST(n AS BIGINT) AS n FROM lists"),
    "q1_mutual_friend_list": _sql(
        "mutual_lists",
        """SELECT m.a, m.b, m.mutual_friends FROM mutual_lists m
           JOIN asked q ON m.a = q.a AND m.b = q.b""",
        "asked",
    ),
    "q2_mutual_friend_counts": _sql("counts"),
    "q3_top_mutual_pairs": _sql("top_pairs"),
    "q4_top_pairs_profiles": _sql(
        "top_pairs",
        """SELECT t.n, x.first_name AS a_first, x.last_name AS a_last, x.address AS a_address,
                  y.first_name AS b_first, y.last_name AS b_last, y.address AS b_address
           FROM top_pairs t
           LEFT JOIN profiles x ON t.a = x.user_id
           LEFT JOIN profiles y ON t.b = y.user_id
           ORDER BY t.n DESC, t.a, t.b""",
        "profiles",
    ),
    "q5_mutual_friend_info": _sql(
        "common_text",
        """SELECT CAST(5 AS BIGINT) AS user_a, CAST(9 AS BIGINT) AS user_b, friends
           FROM common_text""",
    ),
    "q6_oldest_friend_top": _sql(
        "top_ages",
        """SELECT t.user_id, p.address, p.city, p.state, t.max_age
           FROM top_ages t LEFT JOIN profiles p ON t.user_id = p.user_id
           ORDER BY t.max_age DESC, t.user_id""",
        "profiles",
    ),
    "q7_reviewers_in_place": _sql("in_place"),
    "q8_top_rated": _sql(
        "listed_top",
        """SELECT DISTINCT business_id, full_address, categories, avg_stars
           FROM listed_top
           ORDER BY avg_stars DESC NULLS LAST, business_id, full_address, categories""",
    ),
}
