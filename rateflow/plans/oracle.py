"""DuckDB SQL equivalents of the catalogue queries (the correctness oracle).

The tables ``part lineitem orders customer`` are views over the same Parquet files. Each SQL
string is self-contained (CTEs only), produces the same column names as the Spark
query, renders arrays as ``|``-joined strings and rounds means to 6 decimals.
"""

from __future__ import annotations

from rateflow.functions.hashing import DEFAULT_SEEDS, MIX_MULTIPLIER_1, MIX_MULTIPLIER_2, MIX_SHIFT_1, MIX_SHIFT_2
from rateflow.plans import catalog as C
from rateflow.sources.tables import DELTA_FROM

_TWO31 = 1 << 31
_TWO32 = 1 << 32


def _lit_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]::VARCHAR[]"


def _pmod(x: str, m: int) -> str:
    return f"((({x}) % {m} + {m}) % {m})"


def _wrap32(x: str) -> str:
    return f"({_pmod(f'({x}) + {_TWO31}', _TWO32)} - {_TWO31})"


def _i32(v: int) -> int:
    return v - _TWO32 if v >= _TWO31 else v


def sql_tag_hash(tag: str, seed: int) -> str:
    """The MinHash per-tag hash as a DuckDB expression over the string ``tag``."""
    s = f"concat({tag}, '{seed}')"
    h = (f"list_reduce(list_prepend(0::BIGINT, list_transform(string_split({s}, ''), "
         f"lambda ch: unicode(ch)::BIGINT)), lambda acc, ch: (acc * 31 + ch) % {_TWO32})")
    k = _wrap32(h)
    k = _wrap32(f"{k} * ({_i32(MIX_MULTIPLIER_1)})")
    k = f"floor(({k}) / {1 << MIX_SHIFT_1}.0)::BIGINT"
    k = _wrap32(f"{k} * ({_i32(MIX_MULTIPLIER_2)})")
    k = f"floor(({k}) / {1 << MIX_SHIFT_2}.0)::BIGINT"
    return f"abs({k})::INTEGER"


def sql_minhash(tags: str, seed: int, var: str) -> str:
    return f"list_min(list_transform({tags}, lambda {var}: {sql_tag_hash(var, seed)}))"


def sql_signature(tags: str) -> str:
    return ", ".join(f"{sql_minhash(tags, s, f't{i}')} AS sig_{i}" for i, s in enumerate(DEFAULT_SEEDS))


ITEMS = ("items AS (SELECT p_partkey AS item_id, p_name AS title, "
         "list_concat([p_type], string_split(p_name, ' ')) AS tags FROM part)")
ITEMS_D = ("items_d AS (SELECT item_id, title, tags FROM (SELECT *, row_number() OVER "
           "(PARTITION BY item_id ORDER BY title, tags) AS rn_ FROM items) WHERE rn_ = 1)")
_RATING_COLS = ("o_custkey AS user_id, l_partkey AS item_id, {old} AS old_rating, "
                "ceil(l_quantity / 5) / 2 AS rating, epoch(l_shipdate)::BIGINT AS ts")
_R_FROM = "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
RATINGS = f"ratings AS (SELECT {_RATING_COLS.format(old='NULL::DOUBLE')} {_R_FROM})"
BASE = (f"base AS (SELECT {_RATING_COLS.format(old='NULL::DOUBLE')} {_R_FROM} "
        f"WHERE l_shipdate < TIMESTAMP '{DELTA_FROM}')")
_OLD = "CASE WHEN l_returnflag = 'R' THEN 0.5 * ((l_linenumber % 9) + 1) END::DOUBLE"


def _delta(name: str, since: str, until: str | None = None) -> str:
    cond = f"l_shipdate >= TIMESTAMP '{since}'"
    if until:
        cond += f" AND l_shipdate < TIMESTAMP '{until}'"
    return f"{name} AS (SELECT {_RATING_COLS.format(old=_OLD)} {_R_FROM} WHERE {cond})"


DELTA = _delta("delta", DELTA_FROM)
YEAR = "year(to_timestamp(ts))::INTEGER"


def _state(name: str, ratings: str) -> str:
    return (f"{name} AS (SELECT i.item_id, i.title, i.tags, coalesce(a.n, 0)::BIGINT AS n, "
            f"coalesce(a.s, 0.0) AS s, CASE WHEN coalesce(a.n, 0) > 0 THEN a.s / a.n ELSE 0.0 END AS avg "
            f"FROM items_d i LEFT JOIN (SELECT item_id, count(*) AS n, sum(rating) AS s FROM {ratings} "
            f"GROUP BY item_id) a USING (item_id))")


def _fold(name: str, deltas: str) -> str:
    return (f"{name} AS (SELECT item_id, sum(rating - coalesce(old_rating, 0.0)) AS ds, "
            f"count(*) FILTER (WHERE old_rating IS NULL) AS dn, count(*) AS n_rows "
            f"FROM {deltas} GROUP BY item_id)")


def _apply(name: str, state: str, fold: str) -> str:
    t = "f.item_id IS NOT NULL"
    return (f"{name} AS (SELECT s.item_id, s.title, s.tags, "
            f"CASE WHEN {t} THEN s.n + f.dn ELSE s.n END AS n, "
            f"CASE WHEN {t} THEN s.s + f.ds ELSE s.s END AS s, "
            f"CASE WHEN {t} THEN coalesce((s.s + f.ds) / nullif(s.n + f.dn, 0), 0.0) ELSE s.avg END AS avg "
            f"FROM {state} s LEFT JOIN {fold} f USING (item_id))")


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


STATE_OUT = "SELECT item_id, title, array_to_string(tags, '|') AS tags, n, s, round(avg, 6) AS avg FROM {t}"

_SCALE = ("CASE WHEN {x} > {r} THEN 5.0 - {r} WHEN {x} < {r} THEN {r} - 1.0 ELSE 1.0 END")


def _ndev(rating: str, avg: str) -> str:
    sc = _SCALE.format(x=rating, r=avg)
    num = f"({rating} - {avg})"
    return (f"CASE WHEN {sc} <> 0 THEN {num} / {sc} WHEN {num} > 0 THEN 'inf'::DOUBLE "
            f"WHEN {num} < 0 THEN '-inf'::DOUBLE ELSE 'nan'::DOUBLE END")


def _predict(ua: str, dev: str) -> str:
    r = f"coalesce({ua}, 0.0)"
    return (f"CASE WHEN {dev} IS NULL THEN {r} ELSE {r} + {dev} * "
            f"({_SCALE.format(x=f'({r} + {dev})', r=r)}) END")


def _baseline(prefix: str, ratings: str) -> list[str]:
    return [
        f"{prefix}ua AS (SELECT user_id, avg(rating) AS user_avg, count(*) AS n_ratings "
        f"FROM {ratings} GROUP BY user_id)",
        f"{prefix}nd AS (SELECT r.user_id, r.item_id, r.rating, u.user_avg, "
        f"{_ndev('r.rating', 'u.user_avg')} AS ndev FROM {ratings} r JOIN {prefix}ua u USING (user_id))",
        f"{prefix}dev AS (SELECT item_id, avg(ndev) AS item_dev, count(*) AS n_ratings "
        f"FROM {prefix}nd GROUP BY item_id)",
    ]


INDEX = f"idx AS (SELECT item_id, title, tags, {sql_signature('tags')} FROM items)"
REQUESTS = ("req AS (SELECT l.user_id AS query_id, l.user_id, i.tags FROM "
            "(SELECT user_id, item_id FROM (SELECT user_id, item_id, row_number() OVER "
            "(PARTITION BY user_id ORDER BY ts DESC, item_id DESC) AS rn_ FROM ratings) WHERE rn_ = 1) l "
            "JOIN items_d i USING (item_id))")
REQ_SIG = f"req_sig AS (SELECT query_id, user_id, {sql_signature('tags')} FROM req)"
CANDS = ("cands AS (SELECT q.query_id, q.user_id, x.item_id FROM req_sig q JOIN idx x "
         "ON q.sig_0 = x.sig_0 AND q.sig_1 = x.sig_1 "
         "WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = q.user_id AND r.item_id = x.item_id))")
KW_QUERIES = ("kwq AS (SELECT DISTINCT array_to_string(kw, ',') AS query_id, kw AS keywords FROM ("
              "SELECT [p_type, split_part(p_name, ' ', 1)] AS kw FROM part UNION ALL "
              "SELECT [p_type] AS kw FROM part UNION ALL SELECT []::VARCHAR[] AS kw FROM part))")


def _keyword_avg(state: str, keywords: list[str], rated_only: bool = False) -> str:
    if not keywords:
        return f"SELECT -1.0::DOUBLE AS keyword_avg, 0::BIGINT AS n_items"
    cond = f"list_has_all(tags, {_lit_list(keywords)})"
    if rated_only:
        cond += " AND n > 0"
    return (f"SELECT round(coalesce(avg(avg), -1.0), 6) AS keyword_avg, count(*) AS n_items "
            f"FROM {state} WHERE {cond}")


def _lookup(keep: bool) -> str:
    join = "LEFT JOIN" if keep else "JOIN"
    return (_with(ITEMS, INDEX,
                  "q AS (SELECT DISTINCT [p_type] AS tags FROM part)",
                  f"qs AS (SELECT tags, {sql_signature('tags')} FROM q)")
            + "SELECT array_to_string(qs.tags, '|') AS query_tags, qs.sig_0, qs.sig_1, "
              "x.item_id, x.title AS item_title "
              f"FROM qs {join} idx x ON qs.sig_0 = x.sig_0 AND qs.sig_1 = x.sig_1")


def _tags_filter(cond: str) -> str:
    return _with(ITEMS) + f"SELECT item_id, title, array_to_string(tags, '|') AS tags FROM items WHERE {cond}"


WINNERS = ("w AS (SELECT year, item_id, title, tags, n AS n_ratings FROM ("
           "SELECT c.year, c.item_id, i.title, i.tags, c.n, row_number() OVER "
           "(PARTITION BY c.year ORDER BY c.n DESC, c.item_id DESC) AS rn_ "
           f"FROM (SELECT {YEAR} AS year, item_id, count(*) AS n FROM ratings GROUP BY ALL) c "
           "JOIN items_d i USING (item_id)) WHERE rn_ = 1)")
WON = ("won AS (SELECT tag, count(*) AS n_years FROM (SELECT DISTINCT year, unnest(tags) AS tag FROM w) "
       "GROUP BY tag)")


def build() -> dict[str, str]:
    all_ctes = [ITEMS, ITEMS_D, RATINGS, _state("st", "ratings")]
    base_ctes = [ITEMS, ITEMS_D, BASE, _state("st", "base")]
    q: dict[str, str] = {}
    q["load_items_text"] = _with(ITEMS) + "SELECT item_id, title, array_to_string(tags, '|') AS tags FROM items"
    q["load_ratings_text"] = _with(RATINGS) + "SELECT * FROM ratings"
    q["load_delta_text"] = _with(DELTA) + "SELECT * FROM delta"
    q["load_ratings_text_rejected"] = (_with(RATINGS) + "SELECT concat_ws('|', user_id, item_id, '?', ts) AS line "
                                       f"FROM ratings WHERE user_id % {C.DAMAGED_STEP} = 0")
    q["load_ratings_text_diverted"] = (
        _with(RATINGS) + f"SELECT user_id, item_id, rating, ts, NULL::VARCHAR AS line FROM ratings WHERE user_id % {C.DAMAGED_STEP} <> 0 "
        f"UNION ALL SELECT NULL, NULL, NULL, NULL, concat_ws('|', user_id, item_id, '?', ts) FROM ratings WHERE user_id % {C.DAMAGED_STEP} = 0")
    q["items_per_year"] = (_with(RATINGS) + f"SELECT year, count(*) AS n_items FROM "
                           f"(SELECT DISTINCT {YEAR} AS year, item_id FROM ratings) GROUP BY year")
    q["rating_counts_year_item"] = (_with(RATINGS) + f"SELECT {YEAR} AS year, item_id, count(*) AS n "
                                    "FROM ratings GROUP BY ALL")
    win = [ITEMS, ITEMS_D, RATINGS, WINNERS]
    q["top_item_per_year"] = _with(*win) + "SELECT year, item_id, title, n_ratings FROM w"
    q["top_tags_per_year"] = (_with(*win) + "SELECT year, item_id, array_to_string(tags, '|') AS tags, "
                              "n_ratings FROM w")
    q["tag_years_won"] = _with(*win, WON) + "SELECT tag, n_years FROM won"
    q["least_most_tag"] = (_with(*win, WON) + "SELECT lo.tag AS least_tag, lo.n_years AS least_years, "
                           "hi.tag AS most_tag, hi.n_years AS most_years FROM "
                           "(SELECT * FROM won ORDER BY n_years, tag LIMIT 1) lo, "
                           "(SELECT * FROM won ORDER BY n_years DESC, tag DESC LIMIT 1) hi")
    q["items_with_all_tags"] = _tags_filter(f"list_has_all(tags, {_lit_list(C.ALL_TAGS)})")
    q["items_with_all_tags_empty"] = _tags_filter("TRUE")
    q["items_with_any_tag"] = _tags_filter(f"list_has_any(tags, {_lit_list(C.ANY_TAGS)})")
    q["item_stats"] = _with(*all_ctes) + STATE_OUT.format(t="st")
    q["title_averages"] = _with(*all_ctes) + "SELECT item_id, title, round(avg, 6) AS avg FROM st"
    q["title_merged"] = (_with(*all_ctes) + "SELECT title, round(sum(avg), 6) AS sum_avg FROM st "
                         "GROUP BY title")
    q["keyword_average"] = _with(*all_ctes) + _keyword_avg("st", C.KEYWORDS)
    q["keyword_average_none"] = _with(*all_ctes) + _keyword_avg("st", C.KEYWORDS_NONE)
    q["keyword_average_rated_only"] = _with(*all_ctes) + _keyword_avg("st", C.KEYWORDS, rated_only=True)
    q["keyword_averages"] = (_with(*all_ctes, KW_QUERIES) +
                             "SELECT q.query_id, round(coalesce(avg(s.avg), -1.0), 6) AS keyword_avg, "
                             "count(s.item_id) AS n_items FROM kwq q LEFT JOIN st s "
                             "ON list_has_all(s.tags, q.keywords) AND len(q.keywords) > 0 GROUP BY q.query_id")
    q["delta_fold"] = _with(DELTA, _fold("f", "delta")) + "SELECT * FROM f"
    apply_ctes = [*base_ctes, DELTA, _fold("f", "delta"), _apply("st2", "st", "f")]
    q["apply_delta"] = _with(*apply_ctes) + STATE_OUT.format(t="st2")
    q["apply_delta_twice"] = (_with(*base_ctes, _delta("d1", DELTA_FROM, C.SECOND_DELTA_FROM),
                                    _delta("d2", C.SECOND_DELTA_FROM), _fold("f1", "d1"),
                                    _fold("f2", "d2"), _apply("st2", "st", "f1"),
                                    _apply("st3", "st2", "f2"))
                              + STATE_OUT.format(t="st3"))
    q["keyword_average_after_delta"] = _with(*apply_ctes) + _keyword_avg("st2", C.KEYWORDS)
    q["apply_delta_stream"] = q["apply_delta_stored"] = q["apply_delta"]
    q["keyword_averages_after_delta"] = (_with(*apply_ctes, KW_QUERIES) +
                                         "SELECT q.query_id, round(coalesce(avg(s.avg), -1.0), 6) AS keyword_avg, "
                                         "count(s.item_id) AS n_items FROM kwq q LEFT JOIN st2 s "
                                         "ON list_has_all(s.tags, q.keywords) AND len(q.keywords) > 0 GROUP BY q.query_id")
    q["tag_hash"] = (_with(ITEMS, "tg AS (SELECT DISTINCT unnest(tags) AS tag FROM items)")
                     + " UNION ALL ".join(
                         f"SELECT tag, {s}::INTEGER AS seed, {sql_tag_hash('tag', s)} AS hash FROM tg"
                         for s in DEFAULT_SEEDS))
    q["item_signatures"] = _with(ITEMS, INDEX) + "SELECT item_id, sig_0, sig_1 FROM idx"
    q["lsh_buckets"] = (_with(ITEMS, INDEX) + "SELECT sig_0, sig_1, count(*) AS n_items FROM idx "
                        "GROUP BY sig_0, sig_1")
    q["lsh_lookup"] = _lookup(False)
    q["lsh_lookup_keep_unmatched"] = _lookup(True)
    bl = _baseline("", "ratings")
    q["user_averages"] = (_with(RATINGS, *bl) + "SELECT user_id, round(user_avg, 6) AS user_avg, n_ratings "
                          "FROM ua")
    q["ratings_with_user_avg"] = (_with(RATINGS, *bl) + "SELECT r.user_id, r.item_id, r.rating, r.ts, "
                                  "round(u.user_avg, 6) AS user_avg FROM ratings r JOIN ua u USING (user_id)")
    q["ratings_with_user_avg_stored"] = q["ratings_with_user_avg"]
    users = ", ".join(str(u) for u, _, _ in C.REQUESTS_IN_MEMORY)
    q["rated_items_lookup"] = _with(RATINGS) + f"SELECT user_id, item_id, rating, ts FROM ratings WHERE user_id IN ({users})"
    q["normalized_deviation"] = (_with(RATINGS, *bl) + "SELECT user_id, item_id, rating, "
                                 "round(ndev, 6) AS ndev FROM nd")
    q["item_deviation"] = (_with(RATINGS, *bl) + "SELECT item_id, round(item_dev, 6) AS item_dev, "
                           "n_ratings FROM dev")
    q["baseline_predict"] = (_with(BASE, DELTA, *_baseline("b", "base"),
                                   "pairs AS (SELECT DISTINCT user_id, item_id FROM delta)")
                             + f"SELECT p.user_id, p.item_id, round({_predict('u.user_avg', 'd.item_dev')}, 6) "
                               "AS prediction FROM pairs p LEFT JOIN bua u USING (user_id) "
                               "LEFT JOIN bdev d USING (item_id)")
    q["rated_items_of_user"] = (_with(RATINGS) + "SELECT user_id, item_id FROM ratings "
                                "WHERE user_id IN (SELECT c_custkey FROM customer)")
    rec = [ITEMS, ITEMS_D, RATINGS, INDEX, REQUESTS, REQ_SIG, CANDS]
    q["unseen_candidates"] = (_with(BASE, DELTA, "pairs AS (SELECT DISTINCT user_id, item_id FROM delta)")
                              + "SELECT user_id, item_id FROM pairs p WHERE NOT EXISTS "
                                "(SELECT 1 FROM base b WHERE b.user_id = p.user_id AND b.item_id = p.item_id)")
    q["als_coldstart"] = (_with(BASE, DELTA, "pairs AS (SELECT DISTINCT user_id, item_id FROM delta)")
                          + "SELECT user_id, item_id, user_id IN (SELECT user_id FROM base) "
                            "AND item_id IN (SELECT item_id FROM base) AS has_prediction FROM pairs")
    q["recommend_als_shape"] = (
        _with(*rec, "n AS (SELECT query_id, count(*) AS n FROM cands GROUP BY query_id)")
        + f"SELECT query_id, least(n, {C.TOP_K})::BIGINT AS n_items, 0::BIGINT AS n_seen, "
          f"0::BIGINT AS n_outside, (least(n, {C.TOP_K}) * (least(n, {C.TOP_K}) + 1) / 2)::BIGINT AS rank_sum FROM n")
    q["als_normal_equations"] = _with(RATINGS) + "SELECT user_id, count(*) AS n_ratings, true AS solved FROM ratings GROUP BY user_id"
    q["als_fold_in"] = (_with(BASE, DELTA) + "SELECT user_id, count(*) AS n_ratings, 10::INTEGER AS rank FROM delta "
                        "WHERE item_id IN (SELECT item_id FROM base) GROUP BY user_id")
    q["recommender_fit"] = (_with(*rec, "n AS (SELECT query_id, count(*) AS n FROM cands GROUP BY query_id)")
                            + f"SELECT query_id, least(n, {C.TOP_K})::BIGINT AS n_baseline, least(n, {C.TOP_K})::BIGINT AS n_collaborative FROM n")

    def baseline_top(requests: str, limit: str) -> str:
        return (_with(ITEMS, ITEMS_D, RATINGS, INDEX, requests, f"req_sig AS (SELECT *, {sql_signature('tags')} FROM req)", *bl,
                      "cands AS (SELECT q.query_id, q.user_id, q.k, x.item_id FROM req_sig q JOIN idx x "
                      "ON q.sig_0 = x.sig_0 AND q.sig_1 = x.sig_1 WHERE NOT EXISTS "
                      "(SELECT 1 FROM ratings r WHERE r.user_id = q.user_id AND r.item_id = x.item_id))",
                      "scored AS (SELECT c.query_id, c.user_id, c.item_id, c.k, "
                      f"round({_predict('u.user_avg', 'd.item_dev')}, 6) AS prediction FROM cands c "
                      "LEFT JOIN ua u USING (user_id) LEFT JOIN dev d USING (item_id))")
                + "SELECT query_id, user_id, item_id, prediction, rank FROM (SELECT *, row_number() OVER "
                  "(PARTITION BY query_id ORDER BY CASE WHEN prediction IS NULL OR isnan(prediction) THEN 1 ELSE 0 END, "
                  f"prediction DESC, item_id)::INTEGER AS rank FROM scored) WHERE rank <= {limit}")

    given = ", ".join(f"({i}, {u}, {_lit_list(t)}, {k})" for i, (u, t, k) in enumerate(C.REQUESTS_IN_MEMORY))
    q["recommend_baseline"] = baseline_top(REQUESTS.replace("i.tags FROM", f"i.tags, {C.TOP_K} AS k FROM"), str(C.TOP_K))
    known = REQUESTS.replace("i.tags FROM", f"i.tags, {C.TOP_K} AS k FROM").replace("req AS (", "known AS (", 1)
    q["recommend_baseline_cold"] = baseline_top(
        known + f", req AS (SELECT * FROM known UNION ALL SELECT -1 - query_id, user_id + {C.COLD_USERS}, tags, k FROM known)", str(C.TOP_K))
    q["recommend_baseline_own_k"] = baseline_top(
        f"req AS (SELECT query_id::BIGINT AS query_id, user_id::BIGINT AS user_id, tags, k FROM (VALUES {given}) v(query_id, user_id, tags, k))", "k")
    return q


ORACLE_SQL = build()
