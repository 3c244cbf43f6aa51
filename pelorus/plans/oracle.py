"""SQL for the registered queries, written against the raw tables and independent of the DataFrame plans.

Queries are put together from named common table expressions; ``sql`` adds those a statement needs.
"""

from __future__ import annotations

import re

K = 20
POOL = 500
DIMENSIONS = 8

# name -> body. A body may name any other entry; the ones reachable from a statement are put in its WITH clause.
_CTE: dict[str, str] = {}


def _add(name: str, body: str) -> str:
    _CTE[name] = body
    return name


def sql(statement: str) -> str:
    order: list[str] = []

    def visit(text: str) -> None:
        for name in sorted(set(re.findall(r"\bc_[a-z0-9_]+\b", text))):
            if name in _CTE and name not in order:
                visit(_CTE[name])
                if name not in order:
                    order.append(name)

    visit(statement)
    if not order:
        return statement
    parts = ",\n".join(f"{name} AS MATERIALIZED ({_CTE[name]})" for name in order)
    return f"WITH {parts}\n{statement}"


# --- shared tables --------------------------------------------------------------------------------------------------

_add(
    "c_log",
    """SELECT o_custkey AS user_id, l_partkey AS item_id, l_shipdate AS date_time, ceil(l_quantity / 10) AS rating
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
_add("c_pos", "SELECT * FROM c_log WHERE rating >= 4")
_add(
    "c_active",
    "SELECT * FROM c_pos WHERE user_id IN (SELECT user_id FROM c_pos GROUP BY user_id HAVING count(*) >= 2)",
)
_add("c_frame", "SELECT c_active.* FROM c_active JOIN part ON p_partkey = item_id")
_add(
    "c_last",
    """SELECT user_id, date_time AS last_time, n AS n_at_last FROM (
         SELECT user_id, date_time, count(*) AS n, max(date_time) OVER (PARTITION BY user_id) AS m
         FROM c_frame GROUP BY user_id, date_time) WHERE date_time = m""",
)
_add(
    "c_numbered",
    """SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date_time DESC, item_id DESC) AS place
       FROM c_frame WHERE user_id NOT IN (SELECT user_id FROM c_last WHERE n_at_last > 1)""",
)
_add("c_train", "SELECT user_id, item_id, date_time, rating FROM c_numbered WHERE place > 1")
_add("c_test", "SELECT user_id, item_id, date_time, rating FROM c_numbered WHERE place = 1")
_add("c_users", "SELECT user_id FROM c_test")
_add("c_tasted", "SELECT user_id, item_id - item_id % 4 + user_id % 4 AS item_id, date_time FROM c_frame")
_add(
    "c_tasted_train",
    """SELECT user_id, item_id FROM (
         SELECT *, max(date_time) OVER (PARTITION BY user_id) AS last_time, row_number() OVER (PARTITION BY user_id ORDER BY date_time DESC) AS place FROM c_tasted)
       WHERE place > 1 AND user_id NOT IN (SELECT user_id FROM c_last WHERE n_at_last > 1)""",
)
_add("c_seen", "SELECT user_id, item_id, count(*) AS m FROM c_train GROUP BY user_id, item_id")
_add(
    "c_pop",
    """SELECT item_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, item_id) AS place
       FROM c_train GROUP BY item_id""",
)
_add("c_sizes", "SELECT user_id, count(*) AS n_rows FROM c_train GROUP BY user_id")
_add(
    "c_items",
    """SELECT p_partkey AS item_id, p_name AS name, p_brand AS tags, p_type AS ingredients, p_size AS size,
              p_retailprice AS price FROM part""",
)
_add("c_cold_train", "SELECT * FROM c_train WHERE item_id NOT IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#13')")
_add("c_cold_seen", "SELECT DISTINCT user_id, item_id FROM c_cold_train")
_add(
    "c_cold_pop",
    """SELECT item_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, item_id) AS place
       FROM c_cold_train GROUP BY item_id""",
)
_add(
    "c_events",
    """SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, ts AS date_time, event_type
       FROM events""",
)


def first_unseen(users: str, order: str, seen: str, k: int) -> str:
    """First k items of ``order`` (item_id, place) per user outside ``seen``."""
    return f"""SELECT user_id, item_id, place, rank FROM (
        SELECT u.user_id, o.item_id, o.place, row_number() OVER (PARTITION BY u.user_id ORDER BY o.place) AS rank
        FROM {users} u CROSS JOIN {order} o
        WHERE NOT EXISTS (SELECT 1 FROM {seen} s WHERE s.user_id = u.user_id AND s.item_id = o.item_id))
        WHERE rank <= {k}"""


def best(scored: str, k: int) -> str:
    """Top k per user of ``scored`` (user_id, item_id, score), scores rounded first."""
    return f"""SELECT * FROM (
        SELECT user_id, item_id, round(score, 10) AS score,
               row_number() OVER (PARTITION BY user_id ORDER BY round(score, 10) DESC, item_id) AS rank FROM {scored})
        WHERE rank <= {k}"""


def filled(lists: str, users: str, pop: str, seen: str, k: int) -> str:
    """``lists`` (user_id, item_id, rank, score) completed with unseen popular items."""
    return f"""SELECT user_id, item_id, rank, score FROM {lists} UNION ALL
        SELECT user_id, item_id, rank, NULL AS score FROM (
          SELECT u.user_id, p.item_id, h.have + row_number() OVER (PARTITION BY u.user_id ORDER BY p.place) AS rank
          FROM {users} u
          JOIN (SELECT x.user_id, count(l.item_id) AS have FROM {users} x LEFT JOIN {lists} l ON l.user_id = x.user_id
                GROUP BY x.user_id HAVING count(l.item_id) < {k}) h ON h.user_id = u.user_id
          CROSS JOIN {pop} p
          WHERE NOT EXISTS (SELECT 1 FROM {seen} s WHERE s.user_id = u.user_id AND s.item_id = p.item_id)
            AND NOT EXISTS (SELECT 1 FROM {lists} l WHERE l.user_id = u.user_id AND l.item_id = p.item_id))
        WHERE rank <= {k}"""


def as_list(source: str) -> str:
    return sql(f"SELECT user_id, item_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM {source}")


def as_plain(source: str) -> str:
    return sql(f"SELECT user_id, item_id, CAST(rank AS INTEGER) AS rank FROM {source}")


# --- baseline lists -------------------------------------------------------------------------------------------------

_add("c_popularity_all", first_unseen("c_users", "c_pop", "c_seen", POOL))
_add(
    "c_popularity",
    f"SELECT r.user_id, r.item_id, r.rank, CAST(p.n AS DOUBLE) AS score FROM c_popularity_all r JOIN c_pop p USING (item_id) WHERE rank <= {K}",
)


def trend_order(train: str, days: int) -> str:
    return f"""SELECT item_id, recent, row_number() OVER (ORDER BY recent DESC, CASE WHEN recent > 0 THEN 0 ELSE n END DESC,
                 item_id) AS place
        FROM (SELECT item_id, count(*) AS n,
                     count(CASE WHEN date_time >= (SELECT max(date_time) FROM {train}) - INTERVAL {days} DAY THEN 1 END) AS recent
              FROM {train} GROUP BY item_id)"""


def trend_list(name: str, train: str, users: str, seen: str, days: int, k: int) -> None:
    _add(f"{name}_order", trend_order(train, days))
    _add(f"{name}_free", first_unseen(users, f"{name}_order", seen, k))
    _add(
        name,
        f"""SELECT f.user_id, f.item_id, f.rank, CAST(o.recent AS DOUBLE) AS score
            FROM {name}_free f JOIN {name}_order o USING (item_id)""",
    )


trend_list("c_trending", "c_train", "c_users", "c_seen", 180, K)
trend_list("c_trending30", "c_train", "c_users", "c_seen", 30, 5)
_add("c_event_users", "SELECT DISTINCT user_id FROM c_events")
_add("c_event_seen", "SELECT DISTINCT user_id, item_id FROM c_events")
trend_list("c_trending_events", "c_events", "c_event_users", "c_event_seen", 7, K)

_add("c_index", "SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS idx FROM (SELECT DISTINCT item_id FROM c_train)")
_add("c_n", "SELECT count(*) AS n, CASE WHEN count(*) % 7919 <> 0 THEN 7919 ELSE 104729 END AS a FROM c_index")
_add(
    "c_moved",
    """SELECT u.user_id, p.idx AS place, (p.idx * c_n.a + ((u.user_id % c_n.n) * 48271 + 42) % c_n.n) % c_n.n AS idx
       FROM c_users u CROSS JOIN c_n CROSS JOIN c_index p""",
)
_add("c_permuted", "SELECT m.user_id, i.item_id, m.place FROM c_moved m JOIN c_index i ON i.idx = m.idx")
_add(
    "c_random",
    f"""SELECT user_id, item_id, rank FROM (
          SELECT p.user_id, p.item_id, row_number() OVER (PARTITION BY p.user_id ORDER BY place) AS rank
          FROM c_permuted p WHERE NOT EXISTS (SELECT 1 FROM c_seen s WHERE s.user_id = p.user_id AND s.item_id = p.item_id))
        WHERE rank <= {K}""",
)


def markov(prefix: str, train: str, users: str, seen: str, pop: str, k: int) -> None:
    _add(
        f"{prefix}_links",
        f"""SELECT item_i, item_j, count(*) AS n, row_number() OVER (PARTITION BY item_i ORDER BY count(*) DESC, item_j) AS rank
            FROM (SELECT item_id AS item_i, lead(item_id) OVER (PARTITION BY user_id ORDER BY date_time, item_id) AS item_j
                  FROM {train}) WHERE item_j IS NOT NULL GROUP BY item_i, item_j""",
    )
    _add(
        f"{prefix}_from",
        f"""SELECT user_id, item_id FROM (SELECT t.user_id, t.item_id,
              row_number() OVER (PARTITION BY t.user_id ORDER BY t.date_time DESC, t.item_id DESC) AS r
              FROM {train} t JOIN {users} u ON u.user_id = t.user_id) WHERE r = 1""",
    )
    _add(
        f"{prefix}_scored",
        f"""SELECT f.user_id, l.item_j AS item_id, CAST(l.n AS DOUBLE) AS score FROM {prefix}_from f
            JOIN {prefix}_links l ON l.item_i = f.item_id
            WHERE NOT EXISTS (SELECT 1 FROM {seen} s WHERE s.user_id = f.user_id AND s.item_id = l.item_j)""",
    )
    _add(f"{prefix}_best", best(f"{prefix}_scored", k))
    _add(prefix, filled(f"{prefix}_best", users, pop, seen, k))


markov("c_markov_all", "c_train", "c_users", "c_seen", "c_pop", POOL)
_add("c_markov", f"SELECT * FROM c_markov_all WHERE rank <= {K}")

# --- neighbourhood and graph ----------------------------------------------------------------------------------------

_add("c_norms", "SELECT item_id, sqrt(sum(m * m)) AS norm FROM c_seen GROUP BY item_id")
_add(
    "c_sim",
    """SELECT * FROM (SELECT item_i, item_j, sim, row_number() OVER (PARTITION BY item_i ORDER BY sim DESC, item_j) AS rank
       FROM (SELECT c.item_i, c.item_j, round(c.v / (a.norm * b.norm) * (c.v / (c.v + 10.0)), 10) AS sim FROM (
               SELECT x.item_id AS item_i, y.item_id AS item_j, CAST(sum(x.m * y.m) AS DOUBLE) AS v
               FROM c_seen x JOIN c_seen y ON x.user_id = y.user_id AND x.item_id <> y.item_id GROUP BY 1, 2) c
             JOIN c_norms a ON a.item_id = c.item_i JOIN c_norms b ON b.item_id = c.item_j)
       WHERE sim > 0) WHERE rank <= 100""",
)
_add(
    "c_knn_scored",
    """SELECT h.user_id, s.item_j AS item_id, sum(s.sim) AS score
       FROM c_seen h JOIN c_users u ON u.user_id = h.user_id JOIN c_sim s ON s.item_i = h.item_id
       WHERE NOT EXISTS (SELECT 1 FROM c_seen x WHERE x.user_id = h.user_id AND x.item_id = s.item_j)
       GROUP BY h.user_id, s.item_j""",
)
_add("c_knn_best", best("c_knn_scored", K))
_add("c_knn", filled("c_knn_best", "c_users", "c_pop", "c_seen", K))
# Only listed items meet the history again.
_add(
    "c_knn_because",
    """SELECT user_id, item_id, because FROM (
         SELECT l.user_id, l.item_id, h.item_id AS because,
                row_number() OVER (PARTITION BY l.user_id, l.item_id ORDER BY s.sim DESC, h.item_id) AS place
         FROM c_knn_best l JOIN c_seen h ON h.user_id = l.user_id JOIN c_sim s ON s.item_i = h.item_id AND s.item_j = l.item_id)
       WHERE place = 1""",
)

_add("c_degree", "SELECT user_id, 1.0 / count(*) AS w FROM c_seen GROUP BY user_id")
_add("c_fans", "SELECT item_id, CAST(count(*) AS DOUBLE) AS fans FROM c_seen GROUP BY item_id")
_add(
    "c_steps",
    """SELECT x.item_id AS item_i, y.item_id AS item_j, sum(CAST(d.w AS DOUBLE)) / any_value(f.fans) AS p
       FROM c_seen x JOIN c_seen y ON x.user_id = y.user_id AND x.item_id <> y.item_id
       JOIN c_degree d ON d.user_id = x.user_id JOIN c_fans f ON f.item_id = x.item_id GROUP BY 1, 2""",
)
_add(
    "c_ppr_scored",
    """SELECT h.user_id, s.item_j AS item_id, sum(CAST(d.w AS DOUBLE) * s.p) * (100 * 0.85 * 0.85 * 0.85) AS score
       FROM c_seen h JOIN c_users u ON u.user_id = h.user_id JOIN c_degree d ON d.user_id = h.user_id
       JOIN c_steps s ON s.item_i = h.item_id
       WHERE NOT EXISTS (SELECT 1 FROM c_seen x WHERE x.user_id = h.user_id AND x.item_id = s.item_j)
       GROUP BY h.user_id, s.item_j""",
)
_add("c_ppr_best", best("c_ppr_scored", K))
_add("c_ppr", filled("c_ppr_best", "c_users", "c_pop", "c_seen", K))

# --- content --------------------------------------------------------------------------------------------------------


def tokens(column: str) -> str:
    clean = rf"trim(regexp_replace(regexp_replace(lower({column}), '[^a-z0-9\s]+', ' ', 'g'), '\s+', ' ', 'g'))"
    return rf"regexp_replace({clean}, '([^ ]+)', '{column}_\1', 'g')"


def number(column: str) -> str:
    return f"'{column}_' || printf('%.1f', round_even(CAST({column} AS DOUBLE), 1))"


_WORDS = r"'\b\w\w+\b'"

_add(
    "c_docs",
    f"""SELECT item_id, concat_ws(' ', {tokens('name')}, {tokens('tags')}, {tokens('ingredients')}, {number('size')},
        {number('price')}) AS document FROM c_items""",
)
_add(
    "c_tf",
    f"""SELECT item_id, term, count(*) AS tf FROM (
          SELECT item_id, unnest(regexp_extract_all(lower(document), {_WORDS})) AS term FROM c_docs) GROUP BY item_id, term""",
)


def vocabulary(tf: str, known: str, min_df: int) -> str:
    return f"""SELECT term, count(*) AS df,
               ln((1.0 + (SELECT count(*) FROM {known})) / (1.0 + count(*))) + 1.0 AS idf
        FROM {tf} WHERE item_id IN (SELECT item_id FROM {known}) GROUP BY term HAVING count(*) >= {min_df}"""


def weights(tf: str, vocab: str) -> str:
    return f"""SELECT item_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY item_id)) AS w
        FROM (SELECT t.item_id, t.term, t.tf * v.idf AS x FROM {tf} t JOIN {vocab} v ON v.term = t.term)"""


def content(prefix: str, train: str, seen: str, pop: str, depths: tuple[int, ...]) -> None:
    _add(f"{prefix}_known", f"SELECT DISTINCT item_id FROM {train}")
    _add(f"{prefix}_vocab", vocabulary("c_tf", f"{prefix}_known", 2))
    _add(f"{prefix}_w", weights("c_tf", f"{prefix}_vocab"))
    _add(
        f"{prefix}_profile",
        f"""SELECT t.user_id, p.term, sum(p.w) / any_value(z.n) AS w FROM {train} t
            JOIN (SELECT user_id, count(*) AS n FROM {train} GROUP BY user_id) z ON z.user_id = t.user_id
            JOIN {prefix}_w p ON p.item_id = t.item_id GROUP BY t.user_id, p.term""",
    )
    _add(
        f"{prefix}_scored",
        f"""SELECT s.user_id, s.item_id, s.score FROM (
              SELECT u.user_id, i.item_id, sum(u.w * i.w) AS score
              FROM (SELECT user_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY user_id)) AS w FROM {prefix}_profile) u
              JOIN {prefix}_w i ON i.term = u.term GROUP BY u.user_id, i.item_id) s
            JOIN c_users c ON c.user_id = s.user_id
            WHERE round(s.score, 10) > 0 AND NOT EXISTS (
              SELECT 1 FROM {seen} h WHERE h.user_id = s.user_id AND h.item_id = s.item_id)""",
    )
    for k in depths:
        _add(f"{prefix}_best{k}", best(f"{prefix}_scored", k))
        _add(f"{prefix}_list{k}", filled(f"{prefix}_best{k}", "c_users", pop, seen, k))


content("c_content", "c_train", "c_seen", "c_pop", (3, K, 5 * K, POOL))
content("c_cold", "c_cold_train", "c_cold_seen", "c_cold_pop", (K,))


def overlap(pairs: str) -> str:
    return f"""SELECT x.user_id, x.item_id, i.term, i.w * p.w AS part FROM {pairs} x
        JOIN c_content_w i ON i.item_id = x.item_id
        JOIN c_content_profile p ON p.user_id = x.user_id AND p.term = i.term"""


def content_scores(pairs: str) -> str:
    return f"""SELECT x.user_id, x.item_id, coalesce(o.score, 0.0) AS score FROM {pairs} x LEFT JOIN (
          SELECT user_id, item_id, sum(part) AS score FROM ({overlap(pairs)}) GROUP BY user_id, item_id) o
        ON o.user_id = x.user_id AND o.item_id = x.item_id"""


_add("c_overlap20", overlap("c_content_list20"))
_add(
    "c_names20",
    r"""SELECT user_id, item_id, string_agg(regexp_replace(term, '^([^_]*)_(.*)$', '\1: \2'), ', ' ORDER BY place) AS names FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY round(part, 10) DESC, term) AS place
        FROM c_overlap20) WHERE place <= 3 GROUP BY user_id, item_id""",
)

_add(
    "c_event_docs",
    f"""SELECT item_id, concat_ws(' ', {tokens('name')}, {tokens('tags')}, {tokens('ingredients')}, {number('size')}) AS document
        FROM c_items""",
)
_add(
    "c_event_tf",
    f"""SELECT item_id, term, count(*) AS tf FROM (
          SELECT item_id, unnest(regexp_extract_all(lower(document), {_WORDS})) AS term FROM c_event_docs) GROUP BY item_id, term""",
)
_add("c_event_known", "SELECT DISTINCT item_id FROM c_events WHERE item_id IN (SELECT p_partkey FROM part)")
_add("c_event_vocab", vocabulary("c_event_tf", "c_event_known", 1))
_add("c_event_w", weights("c_event_tf", "c_event_vocab"))
_add(
    "c_event_weight",
    """SELECT user_id, item_id, sum(CASE event_type WHEN 'view' THEN 1.0 WHEN 'click' THEN 2.0 WHEN 'signup' THEN 3.0
         WHEN 'purchase' THEN 5.0 WHEN 'error' THEN 0.0 ELSE 1.0 END
         * exp(-0.05 * greatest(0.0, (epoch_us((SELECT max(date_time) FROM c_events)) - epoch_us(date_time)) / 86400e6))) AS weight
       FROM c_events WHERE item_id IN (SELECT p_partkey FROM part) GROUP BY user_id, item_id""",
)

_DOC_CLEAN = r"trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9\s]+', ' ', 'g'), '\s+', ' ', 'g'))"
_add(
    "c_doc_words",
    f"""SELECT doc_id, regexp_extract_all(
          CASE WHEN {_DOC_CLEAN} = '' THEN 'item_id_' || doc_id ELSE regexp_replace({_DOC_CLEAN}, '([^ ]+)', 'text_\\1', 'g') END,
          {_WORDS}) AS words FROM documents""",
)
_add(
    "c_doc_terms",
    """SELECT doc_id AS item_id, unnest(words) AS term FROM c_doc_words UNION ALL
       SELECT doc_id, words[i] || ' ' || words[i + 1] FROM (
         SELECT doc_id, words, unnest(range(1, len(words))) AS i FROM c_doc_words)""",
)
_add("c_doc_tf", "SELECT DISTINCT item_id, term FROM c_doc_terms")
_add("c_doc_known", "SELECT doc_id AS item_id FROM documents")

# --- factors --------------------------------------------------------------------------------------------------------


def arithmetic(ids: str, step: int, modulus: int, half: int) -> str:
    dims = ", ".join(
        f"((id * {step * d + half - step} + {d}) % {modulus} - {half}) / 16.0 AS f{d}" for d in range(DIMENSIONS)
    )
    columns = ", ".join(f"CAST(f{d} AS DOUBLE) AS f{d}" for d in range(DIMENSIONS))
    return f"""SELECT id, CAST(bias AS DOUBLE) AS bias, {columns} FROM (
        SELECT id, ((id * {step}) % {modulus} - {half}) / 64.0 AS bias, {dims} FROM ({ids}))"""


_add("c_p", arithmetic("SELECT DISTINCT user_id AS id FROM c_train", 5, 13, 6))
_add("c_q", arithmetic("SELECT DISTINCT item_id AS id FROM c_train", 7, 17, 8))


def product(a: str, b: str) -> str:
    return "(" + " + ".join(f"{a}.f{d} * {b}.f{d}" for d in range(DIMENSIONS)) + ")"


_UNSEEN = "NOT EXISTS (SELECT 1 FROM c_seen s WHERE s.user_id = p.id AND s.item_id = q.id)"


def factor_list(name: str, score: str, k: int, extra: str = "") -> None:
    _add(
        f"{name}_scored",
        f"""SELECT p.id AS user_id, q.id AS item_id, {score} AS score FROM c_p p JOIN c_users u ON u.user_id = p.id
            CROSS JOIN c_q q {extra} WHERE {_UNSEEN}""",
    )
    _add(f"{name}_best", best(f"{name}_scored", k))
    _add(name, filled(f"{name}_best", "c_users", "c_pop", "c_seen", k))


_SCORE = f"{product('p', 'q')} + q.bias"
factor_list("c_factor", _SCORE, K)
factor_list("c_factor100", _SCORE, 5 * K)
factor_list("c_factor500", _SCORE, POOL)
factor_list("c_mf", f"{_SCORE} + p.bias", K)
factor_list("c_debiased", f"{_SCORE} - 0.15 * ln(1.0 + n.n)", K, "JOIN c_pop n ON n.item_id = q.id")
_PNORM = f"greatest(sqrt({product('p', 'p')} + 1.0), 1e-12)"
_QNORM = f"greatest(sqrt({product('q', 'q')} + q.bias * q.bias), 1e-12)"
factor_list("c_unit", f"({_SCORE}) / ({_PNORM} * {_QNORM})", K)

_add(
    "c_vectors_scored",
    """SELECT a.vec_id AS user_id, b.vec_id AS item_id,
         list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS score
       FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id""",
)
_add("c_vectors", best("c_vectors_scored", 10))

# --- sampling and one training step ---------------------------------------------------------------------------------

_M = 2147483648


def hashed(x: str, seed: int = 0) -> str:
    once = f"(((({x}) % {_M} + {seed}) % {_M}) * 1103515245 + 12345) % {_M}"
    return f"(((({once}) >> 8) * 69069 + ({once})) % {_M})"


_KEY = f"((user_id % {_M}) * 7919 + (item_id % {_M}) * 104729) % {_M} + {15485863 % _M} + attempt * 179424673"
_add(
    "c_negatives",
    f"""SELECT user_id, item_id, negative FROM (
          SELECT d.user_id, d.item_id, i.item_id AS negative,
                 row_number() OVER (PARTITION BY d.user_id, d.item_id ORDER BY d.attempt) AS r
          FROM (SELECT user_id, item_id, attempt, {hashed(_KEY)} % (SELECT n FROM c_n) AS idx
                FROM c_seen CROSS JOIN (SELECT unnest(range(8)) AS attempt)) d
          JOIN c_index i ON i.idx = d.idx
          WHERE NOT EXISTS (SELECT 1 FROM c_seen s WHERE s.user_id = d.user_id AND s.item_id = i.item_id)) WHERE r = 1""",
)
_add("c_triples", "SELECT n.*, CAST(s.m AS DOUBLE) AS m FROM c_negatives n JOIN c_seen s USING (user_id, item_id)")


def columns(prefix: str, alias: str) -> str:
    return f"{alias}.bias AS {prefix}b, " + ", ".join(f"{alias}.f{d} AS {prefix}{d}" for d in range(DIMENSIONS))


_add(
    "c_batch",
    f"""SELECT t.user_id, t.item_id, t.negative, t.m, {columns('p', 'p')}, {columns('i', 'i')}, {columns('j', 'j')}
        FROM c_triples t JOIN c_p p ON p.id = t.user_id JOIN c_q i ON i.id = t.item_id JOIN c_q j ON j.id = t.negative""",
)


def dims(template: str) -> str:
    return ", ".join(template.format(d=d) for d in range(DIMENSIONS))


def stepped(moves: str) -> str:
    """Summed steps per id, shortened by the summed curvature."""
    fields = dims("sum(d{d}) / greatest(1.0, sum(h)) AS d{d}")
    return f"(SELECT id, sum(db) / greatest(1.0, sum(hb)) AS db, {fields} FROM {moves} GROUP BY id)"


def moved(kind: str, table: str, moves: str) -> str:
    fields = dims("round(o.f{d} + coalesce(m.d{d}, 0.0) + 3.14159265e-7, 6) AS f{d}")
    return f"""SELECT '{kind}' AS kind, o.id, round(o.bias + coalesce(m.db, 0.0) + 3.14159265e-7, 6) AS bias, {fields}
        FROM {table} o LEFT JOIN {stepped(moves)} m ON m.id = o.id"""


def squares(letter: str) -> str:
    return "(" + " + ".join(f"{letter}{d} * {letter}{d}" for d in range(DIMENSIONS)) + ")"


_X = "(ib - jb + " + " + ".join(f"p{d} * (i{d} - j{d})" for d in range(DIMENSIONS)) + ")"
_GAP = "(" + " + ".join(f"(i{d} - j{d}) * (i{d} - j{d})" for d in range(DIMENSIONS)) + ")"
_add("c_bpr", f"SELECT *, 1.0 - 1.0 / (1.0 + exp(greatest(-20.0, least(20.0, -{_X})))) AS g FROM c_batch")
_add(
    "c_bpr_user",
    f"""SELECT user_id AS id, 0.0 AS db, {dims('0.05 * m * (g * (i{d} - j{d}) - 0.01 * p{d}) AS d{d}')},
          0.05 * m * ({_GAP} / 4 + 0.01) AS h, 0.0 AS hb FROM c_bpr""",
)
_BEND = f"0.05 * m * ({squares('p')} / 4 + 0.01) AS h, 0.05 * m * 0.26 AS hb"
_add(
    "c_bpr_item",
    f"""SELECT item_id AS id, 0.05 * m * (g - 0.01 * ib) AS db, {dims('0.05 * m * (g * p{d} - 0.01 * i{d}) AS d{d}')}, {_BEND} FROM c_bpr
        UNION ALL SELECT negative, 0.05 * m * (-g - 0.01 * jb), {dims('0.05 * m * (-g * p{d} - 0.01 * j{d})')}, {_BEND} FROM c_bpr""",
)
_PI = " + ".join(f"p{d} * i{d}" for d in range(DIMENSIONS))
_PJ = " + ".join(f"p{d} * j{d}" for d in range(DIMENSIONS))
_add("c_errors", f"SELECT *, 1.0 - (pb + ib + {_PI}) AS e, 0.0 - (pb + jb + {_PJ}) AS z FROM c_batch")


def mf_moves(kind: str, error: str, own: str, bias: str, other: str) -> str:
    """Steps of one side of a pair: ``own`` row with its bias, against the ``other`` row."""
    fields = dims(f"0.05 * m * ({error} * {other}{{d}} - 0.01 * {own}{{d}}) AS d{{d}}")
    return f"""SELECT {kind} AS id, 0.05 * m * ({error} - 0.01 * {bias}) AS db, {fields},
          0.05 * m * ({squares(other)} + 0.01) AS h, 0.05 * m * 1.01 AS hb FROM c_errors"""


_add("c_mf_user", mf_moves("user_id", "e", "p", "pb", "i") + " UNION ALL " + mf_moves("user_id", "z", "p", "pb", "j"))
_add("c_mf_item", mf_moves("item_id", "e", "i", "ib", "p") + " UNION ALL " + mf_moves("negative", "z", "j", "jb", "p"))

# --- hybrid and re-ranking ------------------------------------------------------------------------------------------


def blended(name: str, first: str, second: str, alpha: str) -> None:
    _add(
        name,
        f"""SELECT user_id, item_id, {alpha} * rr_a + (1 - {alpha}) * rr_b AS score FROM (
              SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.item_id, b.item_id) AS item_id,
                     coalesce(CAST(1 AS DOUBLE) / a.rank, 0.0) AS rr_a, coalesce(CAST(1 AS DOUBLE) / b.rank, 0.0) AS rr_b
              FROM {first} a FULL OUTER JOIN {second} b ON a.user_id = b.user_id AND a.item_id = b.item_id) x
            LEFT JOIN c_sizes z USING (user_id)
            WHERE NOT EXISTS (SELECT 1 FROM c_seen s WHERE s.user_id = x.user_id AND s.item_id = x.item_id)""",
    )


def adaptive(alpha: float) -> str:
    return f"CAST(CASE WHEN coalesce(n_rows, 0) <= 5 THEN least({alpha}, 0.3) ELSE {alpha} END AS DOUBLE)"


blended("c_hybrid_scored", "c_factor100", "c_content_list100", "CAST(0.5 AS DOUBLE)")
_add("c_hybrid", best("c_hybrid_scored", K))
for _a in (0.3, 0.5, 0.7, 0.9):
    blended(f"c_blend{int(_a * 10)}_scored", "c_factor100", "c_content_list100", adaptive(_a))
    _add(f"c_blend{int(_a * 10)}", best(f"c_blend{int(_a * 10)}_scored", K))
blended("c_candidates_scored", "c_factor500", "c_content_list500", adaptive(0.9))
_add("c_candidates", best("c_candidates_scored", 100))
_add("c_injected", "SELECT user_id, item_id FROM c_candidates UNION SELECT user_id, item_id FROM c_test")


def features(name: str, pairs: str) -> None:
    _add(f"{name}_content", content_scores(pairs))
    _add(
        name,
        f"""SELECT x.user_id, x.item_id, CASE WHEN t.item_id IS NULL THEN 0 ELSE 1 END AS label,
              coalesce({product('p', 'q')} + q.bias, 0.0) AS bpr_score, c.score AS content_score,
              coalesce(n.n, 0) AS popularity_score, coalesce(h.n, 0) AS user_activity
            FROM {pairs} x
            LEFT JOIN c_p p ON p.id = x.user_id LEFT JOIN c_q q ON q.id = x.item_id
            JOIN {name}_content c ON c.user_id = x.user_id AND c.item_id = x.item_id
            LEFT JOIN c_pop n ON n.item_id = x.item_id
            LEFT JOIN (SELECT user_id, count(*) AS n FROM c_seen GROUP BY user_id) h ON h.user_id = x.user_id
            LEFT JOIN c_test t ON t.user_id = x.user_id AND t.item_id = x.item_id""",
    )


features("c_features", "c_injected")
features("c_rows", "c_candidates")
_add(
    "c_linear",
    """SELECT user_id, item_id, bpr_score * 0.5 + content_score * 2.0 + popularity_score * CAST(0.01 AS DOUBLE)
         - user_activity * CAST(0.001 AS DOUBLE) AS score FROM c_rows""",
)
_add("c_reranked", best("c_linear", K))

# --- stacked lists and metrics --------------------------------------------------------------------------------------


def stacked(name: str, lists: dict[str, str]) -> None:
    _add(name, " UNION ALL ".join(f"SELECT '{m}' AS model, user_id, item_id, rank FROM {t}" for m, t in lists.items()))
    _add(f"{name}_names", " UNION ALL ".join(f"SELECT '{m}' AS model" for m in lists))


stacked(
    "c_lists",
    {
        "popularity": "c_popularity", "trending": "c_trending", "random": "c_random", "markov": "c_markov", "knn": "c_knn",
        "page_rank": "c_ppr", "content": "c_content_list20", "bpr": "c_factor", "mf": "c_mf", "bpr_debiased": "c_debiased",
        "vectors": "c_unit", "hybrid": "c_blend9",
    },
)
stacked("c_pools", {"popularity": "c_popularity_all", "markov": "c_markov_all"})
stacked("c_cold_lists", {"popularity": "c_cold_popularity", "content": "c_cold_list20"})
stacked("c_ltr", {"ltr": "c_reranked"})
stacked("c_alpha", {"0.3": "c_blend3", "0.5": "c_blend5", "0.7": "c_blend7", "0.9": "c_blend9"})
_add("c_cold_popularity", first_unseen("c_users", "c_cold_pop", "c_cold_seen", K))
_add("c_cold_test", "SELECT * FROM c_test WHERE item_id NOT IN (SELECT item_id FROM c_cold_train)")
_add(
    "c_merged",
    """SELECT 'merged' AS model, user_id, item_id, CASE WHEN model = 'popularity' THEN rank * 2 - 1 ELSE rank * 2 END AS rank
       FROM c_lists WHERE model IN ('popularity', 'trending')""",
)
_add("c_merged_names", "SELECT 'merged' AS model")


def per_user(name: str, lists: str, truth: str, k: int) -> None:
    """Recall and gain per (model, user) with one true item per user."""
    _add(
        name,
        f"""SELECT n.model, t.user_id, t.item_id, CAST(count(r.rank) > 0 AS DOUBLE) AS recall,
              coalesce(sum(1 / log2(r.rank + 1.0)), 0.0) AS ndcg
            FROM {truth} t CROSS JOIN {lists}_names n
            LEFT JOIN {lists} r ON r.model = n.model AND r.user_id = t.user_id AND r.item_id = t.item_id AND r.rank <= {k}
            GROUP BY n.model, t.user_id, t.item_id""",
    )


per_user("c_acc", "c_lists", "c_test", K)
per_user("c_acc300", "c_pools", "c_test", 300)
per_user("c_acc_cold", "c_cold_lists", "c_cold_test", K)
per_user("c_acc_ltr", "c_ltr", "c_test", K)
per_user("c_acc_alpha", "c_alpha", "c_test", K)
per_user("c_acc_merged", "c_merged", "c_test", 30)
_add("c_catalog", "SELECT count(DISTINCT item_id) AS size FROM c_train")
_add(
    "c_novelty",
    """SELECT model, sum(bits) / (SELECT count(*) FROM c_test) AS novelty FROM (
         SELECT l.model, l.user_id, avg(-log2(coalesce(CAST(p.n AS DOUBLE), 1e-9) / (SELECT count(*) FROM c_train))) AS bits
         FROM c_lists l LEFT JOIN c_pop p ON p.item_id = l.item_id GROUP BY l.model, l.user_id) GROUP BY model""",
)
_add("c_weight", """SELECT t.user_id, t.item_id, 1 / greatest(0.05, sqrt(coalesce(p.n, 0) / CAST((SELECT max(n) FROM c_pop) AS DOUBLE))) AS weight
       FROM c_test t LEFT JOIN c_pop p ON p.item_id = t.item_id""")
_add(
    "c_snips",
    """SELECT a.model, sum(a.recall * w.weight) / sum(w.weight) AS snips FROM c_acc a
       JOIN c_weight w ON w.user_id = a.user_id AND w.item_id = a.item_id GROUP BY a.model""",
)
# Several true items per user: the held-out one, two random list entries and the first neighbour.
_add(
    "c_several",
    """SELECT user_id, item_id FROM c_test UNION SELECT user_id, item_id FROM c_random WHERE rank <= 2
       UNION SELECT user_id, item_id FROM c_knn WHERE rank = 1""",
)
_add(
    "c_several_hits",
    f"""SELECT n.model, t.user_id, t.item_id, CAST(count(r.rank) > 0 AS DOUBLE) AS hit,
          coalesce(sum(1 / log2(r.rank + 1.0)), 0.0) AS gain,
          any_value(1 / greatest(0.05, sqrt(coalesce(p.n, 0) / CAST((SELECT max(n) FROM c_pop) AS DOUBLE)))) AS weight
        FROM c_several t CROSS JOIN c_lists_names n LEFT JOIN c_pop p ON p.item_id = t.item_id
        LEFT JOIN c_lists r ON r.model = n.model AND r.user_id = t.user_id AND r.item_id = t.item_id AND r.rank <= {K}
        GROUP BY n.model, t.user_id, t.item_id""",
)
_add("c_covered", "SELECT model, count(DISTINCT item_id) / CAST((SELECT size FROM c_catalog) AS DOUBLE) AS coverage FROM c_lists GROUP BY model")
_add(
    "c_macro",
    """SELECT a.model, a.users, a.recall, a.ndcg, c.coverage, n.novelty, s.snips,
         a.model = 'popularity' AND a.recall > 0.15 AS suspicious
       FROM (SELECT model, count(*) AS users, avg(recall) AS recall, avg(ndcg) AS ndcg FROM c_acc GROUP BY model) a
       JOIN c_covered c ON c.model = a.model JOIN c_novelty n ON n.model = a.model JOIN c_snips s ON s.model = a.model""",
)


def sweep(lists: str, budgets: tuple[int, ...]) -> str:
    values = ", ".join(f"({b})" for b in budgets)
    return f"""SELECT n.model, b.b AS candidate_budget,
          (SELECT avg(CASE WHEN EXISTS (SELECT 1 FROM {lists} r WHERE r.model = n.model AND r.user_id = t.user_id
             AND r.item_id = t.item_id AND r.rank <= b.b) THEN 1.0 ELSE 0.0 END) FROM c_test t) AS candidate_recall,
          (SELECT count(DISTINCT item_id) FROM {lists} r WHERE r.model = n.model AND r.rank <= b.b)
             / CAST((SELECT size FROM c_catalog) AS DOUBLE) AS candidate_coverage,
          (SELECT count(*) FROM {lists} r WHERE r.model = n.model AND r.rank <= b.b)
             / CAST((SELECT count(*) FROM c_test) AS DOUBLE) AS avg_candidate_set_size,
          coalesce((SELECT sum(d) FROM (SELECT (count(*) - count(DISTINCT item_id)) / CAST(count(*) AS DOUBLE) AS d FROM {lists} r
             WHERE r.model = n.model AND r.rank <= b.b GROUP BY r.user_id)), 0.0)
             / CAST((SELECT count(*) FROM c_test) AS DOUBLE) AS mean_duplicate_rate
        FROM {lists}_names n CROSS JOIN (SELECT * FROM (VALUES {values}) v(b)) b"""


_add("c_sweep", sweep("c_pools", (50, 100, 300, 500)))
_add("c_sweep_size", sweep("c_pools", (300, 500, 1000)))
_add("c_sweep_merged", sweep("c_merged", (30,)))

# All models' pools at the largest budget, and the cold-item slice with factor model and hybrid.
_DEEP = 5 * POOL
trend_list("c_trending500", "c_train", "c_users", "c_seen", 180, POOL)
_add(
    "c_random500",
    f"""SELECT user_id, item_id, rank FROM (
          SELECT p.user_id, p.item_id, row_number() OVER (PARTITION BY p.user_id ORDER BY place) AS rank
          FROM c_permuted p WHERE NOT EXISTS (SELECT 1 FROM c_seen s WHERE s.user_id = p.user_id AND s.item_id = p.item_id))
        WHERE rank <= {POOL}""",
)
_add("c_ppr_best500", best("c_ppr_scored", POOL))
_add("c_ppr500", filled("c_ppr_best500", "c_users", "c_pop", "c_seen", POOL))
factor_list("c_mf500", f"{_SCORE} + p.bias", POOL)
factor_list("c_debiased500", f"{_SCORE} - 0.15 * ln(1.0 + n.n)", POOL, "JOIN c_pop n ON n.item_id = q.id")
factor_list("c_unit500", f"({_SCORE}) / ({_PNORM} * {_QNORM})", POOL)
factor_list("c_factor_deep", _SCORE, _DEEP)
_add("c_content_best_deep", best("c_content_scored", _DEEP))
_add("c_content_deep", filled("c_content_best_deep", "c_users", "c_pop", "c_seen", _DEEP))
blended("c_blend9_deep_scored", "c_factor_deep", "c_content_deep", adaptive(0.9))
_add("c_blend9_deep", best("c_blend9_deep_scored", POOL))
stacked(
    "c_all_pools",
    {
        "popularity": "c_popularity_all", "trending": "c_trending500", "random": "c_random500", "markov": "c_markov_all",
        "page_rank": "c_ppr500", "content": "c_content_list500", "bpr": "c_factor500", "mf": "c_mf500",
        "bpr_debiased": "c_debiased500", "vectors": "c_unit500", "hybrid": "c_blend9_deep",
    },
)
per_user("c_acc300_all", "c_all_pools", "c_test", 300)
_add("c_sweep_all", sweep("c_all_pools", (50, 100, 300, 500)))
_add("c_sweep_size_all", sweep("c_all_pools", (300, 500, 1000)))

_add("c_cold_p", arithmetic("SELECT DISTINCT user_id AS id FROM c_cold_train", 5, 13, 6))
_add("c_cold_q", arithmetic("SELECT DISTINCT item_id AS id FROM c_cold_train", 7, 17, 8))
_add(
    "c_cold_factor_scored",
    f"""SELECT p.id AS user_id, q.id AS item_id, {_SCORE} AS score FROM c_cold_p p JOIN c_users u ON u.user_id = p.id
        CROSS JOIN c_cold_q q WHERE NOT EXISTS (SELECT 1 FROM c_cold_seen s WHERE s.user_id = p.id AND s.item_id = q.id)""",
)
_add("c_cold_factor_best", best("c_cold_factor_scored", 5 * K))
_add("c_cold_factor100", filled("c_cold_factor_best", "c_users", "c_cold_pop", "c_cold_seen", 5 * K))
_add("c_cold_factor", f"SELECT * FROM c_cold_factor100 WHERE rank <= {K}")
_add("c_cold_best100", best("c_cold_scored", 5 * K))
_add("c_cold_list100", filled("c_cold_best100", "c_users", "c_cold_pop", "c_cold_seen", 5 * K))
_add(
    "c_cold_blend_scored",
    f"""SELECT user_id, item_id, {adaptive(0.9)} * rr_a + (1 - {adaptive(0.9)}) * rr_b AS score FROM (
          SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.item_id, b.item_id) AS item_id,
                 coalesce(CAST(1 AS DOUBLE) / a.rank, 0.0) AS rr_a, coalesce(CAST(1 AS DOUBLE) / b.rank, 0.0) AS rr_b
          FROM c_cold_factor100 a FULL OUTER JOIN c_cold_list100 b ON a.user_id = b.user_id AND a.item_id = b.item_id) x
        LEFT JOIN (SELECT user_id, count(*) AS n_rows FROM c_cold_train GROUP BY user_id) z USING (user_id)""",
)
_add("c_cold_blend", best("c_cold_blend_scored", K))
stacked(
    "c_all_cold",
    {"popularity": "c_cold_popularity", "content": "c_cold_list20", "bpr": "c_cold_factor", "hybrid": "c_cold_blend"},
)
per_user("c_acc_cold_all", "c_all_cold", "c_cold_test", K)

_BUCKET = """CASE WHEN coalesce(n_rows, 0) <= 3 THEN 'Sparse users (<=3)' WHEN coalesce(n_rows, 0) <= 10
  THEN 'Medium users (4-10)' ELSE 'Heavy users (>10)' END"""


def quantiles(source: str, column: str, probs: tuple[float, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({p} AS DOUBLE) AS p, round(quantile_cont(CAST({column} AS DOUBLE), {p}), 6) AS value FROM {source}" for p in probs
    )


_QUANTILES = (0.5, 0.75, 0.9, 0.95, 0.99)


def activity_side(key: str, name: str) -> str:
    return f"""SELECT '{name}' AS side, count(*) AS total, count(CASE WHEN n = 1 THEN 1 END) AS single,
          round(count(CASE WHEN n = 1 THEN 1 END) / CAST(count(*) AS DOUBLE), 6) AS single_share,
          count(CASE WHEN n >= 2 THEN 1 END) AS several,
          round(count(CASE WHEN n >= 2 THEN 1 END) / CAST(count(*) AS DOUBLE), 6) AS several_share
        FROM (SELECT {key}, count(*) AS n FROM c_log GROUP BY {key})"""


def rule(threshold: int) -> str:
    return f"""SELECT CAST({threshold} AS DOUBLE) AS threshold, count(*) AS interactions, count(DISTINCT user_id) AS users,
          count(DISTINCT item_id) AS items,
          (SELECT count(*) FROM (SELECT user_id FROM c_log WHERE rating >= {threshold} GROUP BY user_id HAVING count(*) >= 2)) AS users_with_2plus,
          (SELECT count(*) FROM (SELECT item_id FROM c_log WHERE rating >= {threshold} GROUP BY item_id HAVING count(*) = 1)) AS cold_items
        FROM c_log WHERE rating >= {threshold}"""


def histogram(source: str, value: str, bins: int) -> str:
    return f"""SELECT CAST(least(floor((v - lo) * {bins} / (hi - lo)), {bins - 1}) AS BIGINT) AS bin, count(*) AS n FROM (
          SELECT v, min(v) OVER () AS lo, max(v) OVER () AS hi FROM (SELECT CAST({value} AS DOUBLE) AS v FROM {source})) GROUP BY 1"""


def describe(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count({column}) AS "count", round(avg({column}), 6) AS mean,
          round(stddev_samp({column}), 6) AS std, CAST(min({column}) AS DOUBLE) AS "min",
          round(quantile_cont(CAST({column} AS DOUBLE), 0.25), 6) AS q25, round(quantile_cont(CAST({column} AS DOUBLE), 0.5), 6) AS q50,
          round(quantile_cont(CAST({column} AS DOUBLE), 0.75), 6) AS q75, CAST(max({column}) AS DOUBLE) AS "max" FROM c_items"""


def missing(source: str, names: tuple[str, ...], with_count: bool) -> str:
    count = "count(*) - count({c}) AS missing, " if with_count else ""
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {count.format(c=c)}round((count(*) - count({c})) / CAST(count(*) AS DOUBLE), 6) AS rate FROM {source}"""
        for c in names
    )


_add("c_doc_labels", "SELECT d.doc_id, lang, source, n_chars, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)")
_add("c_items40", "SELECT item_id, name, tags, ingredients, CASE WHEN size <= 40 THEN size END AS size, price FROM c_items")

_add("c_brand_train", "SELECT * FROM c_train WHERE item_id IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#7')")
_add("c_brand_seen", "SELECT DISTINCT user_id, item_id FROM c_brand_train")
_add(
    "c_brand_pop",
    """SELECT item_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, item_id) AS place
       FROM c_brand_train GROUP BY item_id""",
)
_add("c_customers", "SELECT c_custkey AS user_id FROM customer")
markov("c_brand_markov", "c_brand_train", "c_customers", "c_brand_seen", "c_brand_pop", 5)
_add("c_filled_trend", filled("c_trending30", "c_users", "c_pop", "c_seen", K))

_FEATURE_COLUMNS = """user_id, item_id, label, round(bpr_score, 6) AS bpr_score, round(content_score, 6) AS content_score,
  popularity_score, user_activity"""


def rounded_avg(table: str, keys: str) -> str:
    return sql(
        f"SELECT {keys}, count(*) AS users, round(avg(recall), 6) AS recall, round(avg(ndcg), 6) AS ndcg FROM {table} GROUP BY {keys}"
    )


def statements() -> dict[str, str]:
    out = {
        "interactions_view": sql("SELECT * FROM c_log"),
        "csv_interactions": sql("SELECT * FROM c_log"),
        "csv_items": """SELECT doc_id AS item_id, source AS name, CAST(n_chars AS DOUBLE) AS minutes,
            '"' || lang || '",' || chr(10) || text AS description FROM documents""",
        "positive_filter": sql("SELECT * FROM c_pos"),
        "min2_users": sql("SELECT * FROM c_active"),
        "join_items": sql("SELECT a.*, name, tags, ingredients, size, price FROM c_active a JOIN c_items USING (item_id)"),
        "loo_train": sql("SELECT * FROM c_train"),
        "loo_test": sql("SELECT * FROM c_test"),
        "loo_tied_users": sql("SELECT user_id, n_at_last AS n_tied FROM c_last WHERE n_at_last > 1"),
        "last_by_user": sql("SELECT user_id, item_id, date_time, last_time, n_at_last FROM c_frame JOIN c_last USING (user_id)"),
        "topn_items": sql("SELECT item_id, n AS n_rows FROM c_pop WHERE place <= 1000"),
        "top_item_rows": sql("SELECT * FROM c_train WHERE item_id IN (SELECT item_id FROM c_pop WHERE place <= 1000)"),
        "coerce_dates": """SELECT o_orderkey, try_cast(CASE WHEN o_orderstatus = 'P' THEN 'pending ' || o_orderkey
            ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS date_time FROM orders""",
        "item_names": sql(
            "SELECT item_id, coalesce(CASE WHEN ingredients <> 'ECONOMY' THEN name END, 'Unknown Recipe') AS name FROM c_items"
        ),
        "first_row_per_item": sql(
            """SELECT user_id, item_id, date_time, rating FROM (SELECT *, row_number() OVER (PARTITION BY item_id
               ORDER BY date_time, user_id, rating) AS r FROM c_log) WHERE r = 1"""
        ),
        "leakage_check": sql(
            """SELECT count(*) AS test_users, count(CASE WHEN m >= date_time THEN 1 END) AS violations FROM c_test
               LEFT JOIN (SELECT user_id, max(date_time) AS m FROM c_train GROUP BY user_id) USING (user_id)"""
        ),
        "basic_stats": sql(
            """SELECT count(*) AS interactions, count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items,
               round(1 - count(*) / (CAST(count(DISTINCT user_id) AS DOUBLE) * count(DISTINCT item_id)), 6) AS sparsity,
               min(date_time) AS min_date, max(date_time) AS max_date FROM c_log"""
        ),
        "rating_dist": sql("SELECT rating, count(*) AS n FROM c_log GROUP BY rating"),
        "popularity_counts": sql("SELECT item_id, n FROM c_pop"),
        "cold_counts": sql(activity_side("user_id", "users") + " UNION ALL " + activity_side("item_id", "items")),
        "user_quantiles": sql(quantiles("(SELECT count(*) AS n FROM c_log GROUP BY user_id)", "n", _QUANTILES)),
        "item_quantiles": sql(quantiles("(SELECT count(*) AS n FROM c_log GROUP BY item_id)", "n", _QUANTILES)),
        "missing_counts": sql(missing("c_doc_labels", ("doc_id", "lang", "source", "n_chars", "quality", "toxic"), True)),
        "missing_rates": sql(missing("c_items40", ("name", "tags", "ingredients", "size", "price"), False)),
        "describe_items": sql(describe("size") + " UNION ALL " + describe("price")),
        "latency_summary": """SELECT round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS median,
            round(quantile_cont(value, 0.95), 6) AS p95 FROM events""",
        "hist_clip": sql(histogram("c_items", "least(size, 30)", 50)),
        "hist_activity": sql(histogram("(SELECT count(*) AS n FROM c_log GROUP BY user_id)", "n", 40)),
        "rule_summary": sql(rule(4) + " UNION ALL " + rule(5)),
        "join_coverage": """SELECT count(CASE WHEN l.k IS NOT NULL AND p_partkey IS NOT NULL THEN 1 END) AS matched,
            count(CASE WHEN p_partkey IS NULL THEN 1 END) AS missing_in_items, count(CASE WHEN l.k IS NULL THEN 1 END) AS never_used
            FROM (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R') l
            FULL OUTER JOIN part ON p_partkey = l.k""",
        "dup_counts": sql(
            """SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT user_id, item_id FROM c_log)) AS duplicate_pairs,
               count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM c_log)) AS duplicate_rows FROM c_log"""
        ),
        "dup_rows": sql(
            """SELECT user_id, item_id, date_time, rating FROM (SELECT *, count(*) OVER (PARTITION BY user_id, item_id) AS n
               FROM c_log) WHERE n > 1"""
        ),
        "user_history": sql("SELECT user_id, item_id FROM c_seen"),
        "cold_items": sql("SELECT DISTINCT item_id FROM c_cold_test"),
        "warm_cold_users": sql(
            "SELECT user_id, item_id, item_id IN (SELECT item_id FROM c_cold_train) AS warm FROM c_test"
        ),
        "sparse_users": sql("SELECT user_id, n_rows AS n FROM c_sizes WHERE n_rows <= 5"),
        "activity_bucket": sql(f"SELECT user_id, {_BUCKET} AS slice FROM c_users LEFT JOIN c_sizes USING (user_id)"),
        "user_sample": sql(f"SELECT user_id FROM c_users ORDER BY {hashed('user_id', 42)}, user_id LIMIT 500"),
        "first_users": sql("SELECT user_id FROM c_users ORDER BY user_id LIMIT 500"),
        "heavy_user_sample": sql(f"SELECT user_id, n_rows FROM c_sizes WHERE n_rows > 5 ORDER BY {hashed('user_id', 42)}, user_id LIMIT 1"),
        "popularity_topk": as_list("c_popularity"),
        "random_topk": as_plain("c_random"),
        "trending_topk": as_list("c_trending"),
        "trending_events": as_list("c_trending_events"),
        "popularity_fill": as_plain("c_filled_trend"),
        "cold_user_fallback": as_plain("c_brand_markov"),
        "markov_transitions": sql(
            f"SELECT item_i, item_j, n, CAST(rank AS INTEGER) AS rank FROM c_markov_all_links WHERE rank <= {K}"
        ),
        "markov_topk": as_list("c_markov"),
        "knn_sim": sql("SELECT item_i, item_j, round(sim, 6) AS sim, CAST(rank AS INTEGER) AS rank FROM c_sim"),
        "knn_topk": as_list("c_knn"),
        "knn_explain": sql(
            """SELECT l.user_id, l.item_id, CAST(l.rank AS INTEGER) AS rank, CASE
                 WHEN l.score IS NOT NULL THEN 'Recommended because it is similar to a previously liked recipe (recipe_id=' || s.because || ').'
                 WHEN l.user_id IN (SELECT user_id FROM c_seen) THEN 'Recommended due to general popularity.'
                 ELSE 'Recommended due to general popularity (Cold Start).' END AS explanation
               FROM c_knn l LEFT JOIN c_knn_because s ON s.user_id = l.user_id AND s.item_id = l.item_id"""
        ),
        "ppr_topk": as_list("c_ppr"),
        "tfidf_docs": sql("SELECT item_id, document FROM c_docs"),
        "tfidf_vocabulary": sql("SELECT term, df, round(idf, 6) AS idf FROM c_content_vocab"),
        "tfidf_weights": sql("SELECT item_id, term, round(w, 6) AS w FROM c_content_w"),
        "doc_ngrams": sql(f"SELECT term, df, round(idf, 6) AS idf FROM ({vocabulary('c_doc_tf', 'c_doc_known', 2)})"),
        "user_profile": sql("SELECT user_id, term, round(w, 6) AS w FROM c_content_profile"),
        "user_profile_weighted": sql(
            """SELECT e.user_id, p.term, round(sum(e.weight * p.w) / any_value(t.total), 6) AS w FROM c_event_weight e
               JOIN (SELECT user_id, sum(weight) AS total FROM c_event_weight GROUP BY user_id HAVING sum(weight) > 0) t
                 ON t.user_id = e.user_id
               JOIN c_event_w p ON p.item_id = e.item_id GROUP BY e.user_id, p.term"""
        ),
        "content_topk": as_list("c_content_list20"),
        "content_pair_score": sql(
            f"SELECT user_id, item_id, round(score, 6) AS score FROM ({content_scores('c_test')})"
        ),
        "content_explain": sql(
            """SELECT l.user_id, l.item_id, CAST(l.rank AS INTEGER) AS rank, CASE
                 WHEN l.user_id NOT IN (SELECT user_id FROM c_content_profile) THEN 'Recommended due to popularity fallback (cold user).'
                 WHEN n.names IS NOT NULL THEN 'Recommended because it overlaps on: ' || n.names || '.'
                 ELSE 'Recommended due to overall profile match.' END AS explanation
               FROM c_content_list20 l LEFT JOIN c_names20 n ON n.user_id = l.user_id AND n.item_id = l.item_id"""
        ),
        "factor_topk": as_list("c_factor"),
        "mf_topk": as_list("c_mf"),
        "factor_debiased": as_list("c_debiased"),
        "factor_pair_score": sql(
            f"""SELECT t.user_id, t.item_id, round(coalesce({product('p', 'q')} + q.bias, 0.0), 6) AS score FROM c_test t
                LEFT JOIN c_p p ON p.id = t.user_id LEFT JOIN c_q q ON q.id = t.item_id"""
        ),
        "vector_topk": as_list("c_vectors"),
        "vector_normalized": as_list("c_unit"),
        "vector_pair_score": sql(
            f"""SELECT t.user_id, t.item_id, round(coalesce(({_SCORE}) / ({_PNORM} * {_QNORM}), 0.0), 6) AS score FROM c_test t
                LEFT JOIN c_p p ON p.id = t.user_id LEFT JOIN c_q q ON q.id = t.item_id"""
        ),
        "vector_neighbors": sql(
            f"""SELECT q.id AS item_id, round(round({product('p', 'q')} / (sqrt({product('p', 'p')}) * sqrt({product('q', 'q')})), 10), 6) AS similarity
                FROM c_q q JOIN c_q p ON p.id = (SELECT item_id FROM c_pop WHERE place = 1) AND q.id <> p.id
                ORDER BY round({product('p', 'q')} / (sqrt({product('p', 'p')}) * sqrt({product('q', 'q')})), 10) DESC, q.id LIMIT 5"""
        ),
        "top_bias": sql(
            """SELECT b.id AS item_id, coalesce(p_name, 'Unknown Recipe') AS name, round(b.bias, 6) AS bias
               FROM (SELECT * FROM c_q ORDER BY bias DESC, id LIMIT 5) b LEFT JOIN part ON p_partkey = b.id"""
        ),
        "neg_samples": sql("SELECT user_id, item_id, negative FROM c_negatives"),
        "bpr_train": sql("SELECT count(DISTINCT item_id) AS items, true AS finite, true AS better FROM c_tasted_train"),
        "mf_train": sql("SELECT count(DISTINCT item_id) AS items, true AS finite, true AS better FROM c_tasted_train"),
        "bpr_one_step": sql(moved("user", "c_p", "c_bpr_user") + " UNION ALL " + moved("item", "c_q", "c_bpr_item")),
        "mf_one_step": sql(moved("user", "c_p", "c_mf_user") + " UNION ALL " + moved("item", "c_q", "c_mf_item")),
        "hybrid_topk": as_list("c_hybrid"),
        "hybrid_adaptive": as_list("c_blend9"),
        "alpha_sweep": sql(
            """SELECT CAST(a.model AS DOUBLE) AS alpha, a.recall, a.ndcg, c.coverage FROM (
                 SELECT model, round(avg(recall), 6) AS recall, round(avg(ndcg), 6) AS ndcg FROM c_acc_alpha GROUP BY model) a
               JOIN (SELECT model, round(count(DISTINCT item_id) / CAST((SELECT size FROM c_catalog) AS DOUBLE), 6) AS coverage
                     FROM c_alpha GROUP BY model) c ON c.model = a.model"""
        ),
        "recall_ndcg": sql("SELECT model, user_id, round(recall, 6) AS recall, round(ndcg, 6) AS ndcg FROM c_acc"),
        "novelty": sql("SELECT model, round(novelty, 6) AS novelty FROM c_novelty"),
        "coverage": sql("SELECT model, round(coverage, 6) AS coverage FROM c_covered"),
        "snips_user": sql("SELECT model, user_id, round(recall, 6) AS snips FROM c_acc"),
        "several_truths": sql(
            """SELECT model, user_id, round(avg(hit), 6) AS recall, round(sum(gain), 6) AS ndcg,
               round(sum(hit * weight) / sum(weight), 6) AS snips FROM c_several_hits GROUP BY model, user_id"""
        ),
        "snips_pooled": sql("SELECT model, round(snips, 6) AS snips FROM c_snips"),
        "macro_table": sql(
            """SELECT model, users, round(recall, 6) AS recall, round(ndcg, 6) AS ndcg, round(coverage, 6) AS coverage,
               round(novelty, 6) AS novelty, round(snips, 6) AS snips, suspicious FROM c_macro"""
        ),
        "slice_activity": rounded_avg(f"(SELECT *, {_BUCKET} AS slice FROM c_acc LEFT JOIN c_sizes USING (user_id))", "model, slice"),
        "slice_cold": rounded_avg("c_acc_cold", "model"),
        "gini": sql(
            """SELECT model, round(sum((2 * i - n - 1) * x) / (any_value(n) * sum(x)), 6) AS gini FROM (
                 SELECT m.model, coalesce(e.x, 0) AS x, CAST(row_number() OVER (PARTITION BY m.model ORDER BY coalesce(e.x, 0)) AS DOUBLE) AS i,
                        CAST(count(*) OVER (PARTITION BY m.model) AS DOUBLE) AS n
                 FROM part CROSS JOIN c_lists_names m
                 LEFT JOIN (SELECT model, item_id, count(*) AS x FROM c_lists GROUP BY model, item_id) e
                   ON e.model = m.model AND e.item_id = p_partkey) GROUP BY model"""
        ),
        "ild": sql(
            """SELECT model, count(*) AS lists, round(avg(d), 6) AS ild FROM (
                 SELECT a.model, a.user_id, avg(1 - coalesce(c.cos, 0.0)) AS d
                 FROM c_lists a JOIN c_lists b ON a.model = b.model AND a.user_id = b.user_id AND a.item_id < b.item_id
                 LEFT JOIN (SELECT x.item_id AS i, y.item_id AS j, sum(x.w * y.w) AS cos FROM c_content_w x
                            JOIN c_content_w y ON x.term = y.term AND x.item_id < y.item_id GROUP BY 1, 2) c
                   ON c.i = a.item_id AND c.j = b.item_id
                 GROUP BY a.model, a.user_id) GROUP BY model"""
        ),
        "cand_recall": sql("SELECT model, user_id, round(recall, 6) AS recall FROM c_acc300"),
        "cand_hit": sql("SELECT model, user_id, CAST(recall AS INTEGER) AS hit FROM c_acc300"),
        "cand_coverage": sql(
            """SELECT model, round(count(DISTINCT item_id) / CAST((SELECT size FROM c_catalog) AS DOUBLE), 6) AS coverage
               FROM c_pools WHERE rank <= 300 GROUP BY model"""
        ),
        "cand_size": sql("SELECT model, candidate_budget, round(avg_candidate_set_size, 6) AS avg_candidate_set_size FROM c_sweep_size"),
        "dup_rate": sql(
            """SELECT model, user_id, round((count(*) - count(DISTINCT item_id)) / CAST(count(*) AS DOUBLE), 6) AS duplicate_rate
               FROM c_merged WHERE rank <= 30 GROUP BY model, user_id"""
        ),
        "cand_summary": sql(
            """SELECT model, round(candidate_recall, 6) AS candidate_recall_at_30, round(candidate_coverage, 6) AS candidate_coverage_at_30,
               round(avg_candidate_set_size, 6) AS avg_candidate_set_size_at_30, round(mean_duplicate_rate, 6) AS mean_duplicate_rate_at_30
               FROM c_sweep_merged"""
        ),
        "cand_sweep": sql(
            """SELECT model, candidate_budget, round(candidate_recall, 6) AS candidate_recall, round(candidate_coverage, 6) AS candidate_coverage,
               round(avg_candidate_set_size, 6) AS avg_candidate_set_size, round(mean_duplicate_rate, 6) AS mean_duplicate_rate FROM c_sweep"""
        ),
        "ltr_features": sql(f"SELECT {_FEATURE_COLUMNS} FROM c_features"),
        "ltr_scoring_table": sql(f"SELECT {_FEATURE_COLUMNS} FROM c_rows"),
        "ltr_rerank": as_list("c_reranked"),
        "ltr_eval": sql(
            """SELECT model, count(*) AS users, round(avg(recall), 6) AS recall, round(avg(ndcg), 6) AS ndcg FROM c_acc_ltr GROUP BY model"""
        ),
        "run_table": sql(
            """SELECT 'order_lines_rating_ge_4' AS dataset, model, 20 AS k_evaluated,
               CASE WHEN model = 'trending' THEN 'days_window=180' ELSE '' END AS hyperparams,
               round(recall, 4) AS recall, round(ndcg, 4) AS ndcg, round(coverage, 4) AS coverage FROM c_macro"""
        ),
    }
    out["run_log"] = sql(
        """SELECT 'order_lines_rating_ge_4' AS dataset, model, 20 AS k_evaluated,
           CASE WHEN model = 'trending' THEN 'days_window=180' ELSE '' END AS hyperparams,
           round(recall, 4) AS recall, round(ndcg, 4) AS ndcg, round(coverage, 4) AS coverage, true AS stamped
           FROM c_macro, (VALUES (1), (2)) AS runs(run)"""
    )
    out["ltr_pointwise_optimum"] = sql(
        f"""SELECT f.feature, t.n, CAST(0 AS DOUBLE) AS slope FROM (SELECT count(*) AS n FROM c_injected) t,
            (VALUES ('bpr_score'), ('content_score'), ('popularity_score'), ('user_activity'), ('intercept')) AS f(feature)"""
    )
    # One true item per user: it gains against every other row of the list, and each of those loses to it.
    out["ltr_lambda_first"] = sql(
        """SELECT * FROM (WITH placed AS (
             SELECT user_id, item_id, label, 1 / log2(row_number() OVER (PARTITION BY user_id ORDER BY item_id) + 1.0) AS d FROM c_features),
           pairs AS (
             SELECT a.user_id, a.item_id AS up, b.item_id AS down, abs(a.d - b.d) AS change
             FROM placed a JOIN placed b ON a.user_id = b.user_id AND a.label > b.label),
           sums AS (
             SELECT user_id, up AS item_id, change / 2 AS g, change / 4 AS h FROM pairs
             UNION ALL SELECT user_id, down, -change / 2, change / 4 FROM pairs)
           SELECT p.user_id, p.item_id, round(coalesce(sum(s.g), 0.0), 9) AS grad, round(coalesce(sum(s.h), 0.0), 9) AS hess
           FROM placed p LEFT JOIN sums s ON s.user_id = p.user_id AND s.item_id = p.item_id GROUP BY p.user_id, p.item_id)"""
    )
    out["vector_ann_recall"] = sql(
        """SELECT 'factors' AS source, CAST(sum(least(300, i.n - s.n)) AS BIGINT) AS listed, max(i.n) AS indexed, true AS reached
           FROM c_users u JOIN (SELECT user_id, count(*) AS n FROM c_seen GROUP BY user_id) s ON s.user_id = u.user_id,
                (SELECT count(DISTINCT item_id) AS n FROM c_train) i
           UNION ALL SELECT 'embeddings', count(*) * least(300, count(*) - 1), count(*), true FROM embeddings"""
    )
    out["slice_cold_all"] = rounded_avg("c_acc_cold_all", "model")
    out["cand_recall_all"] = sql("SELECT model, user_id, round(recall, 6) AS recall FROM c_acc300_all")
    out["cand_hit_all"] = sql("SELECT model, user_id, CAST(recall AS INTEGER) AS hit FROM c_acc300_all")
    out["cand_coverage_all"] = sql(
        """SELECT model, round(count(DISTINCT item_id) / CAST((SELECT size FROM c_catalog) AS DOUBLE), 6) AS coverage
           FROM c_all_pools WHERE rank <= 300 GROUP BY model"""
    )
    out["cand_size_all"] = sql(
        "SELECT model, candidate_budget, round(avg_candidate_set_size, 6) AS avg_candidate_set_size FROM c_sweep_size_all"
    )
    out["cand_sweep_all"] = sql(
        """SELECT model, candidate_budget, round(candidate_recall, 6) AS candidate_recall, round(candidate_coverage, 6) AS candidate_coverage,
           round(avg_candidate_set_size, 6) AS avg_candidate_set_size, round(mean_duplicate_rate, 6) AS mean_duplicate_rate FROM c_sweep_all"""
    )
    ranked = "row_number() OVER (PARTITION BY user_id ORDER BY date_time DESC, item_id DESC, rating DESC)"
    base = f"(SELECT user_id, item_id, date_time, rating, {ranked} AS place FROM c_frame)"
    out["loo_untied_train"] = sql(f"SELECT user_id, item_id, date_time, rating FROM {base} WHERE place > 1")
    out["loo_untied_test"] = sql(f"SELECT user_id, item_id, date_time, rating FROM {base} WHERE place = 1")
    return out
