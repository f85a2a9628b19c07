"""Target rates and interaction mining."""

from itertools import combinations

from propensity.catalog.registry import ORACLES, L, bin_sql, edges_sql, flat, query, rounded, with_p
from propensity.operators import rates
from propensity.session import work_folder
from propensity.sources import files, frames

CATS = frames.CATEGORIES
MODS = (2, 3, 5, 10, 100)
MIN = 100


@query(with_p("""
  SELECT region, round(avg(y), 6) AS mean, count(*) AS count, CAST(sum(y) AS BIGINT) AS positives,
         round(avg(y) * 100, 6) AS rate_pct FROM p GROUP BY 1"""))
def target_rate_region(spark, folder):
    return rounded(rates.target_rate(frames.orders_frame(spark, folder, ["region", "y"]), "region", "y"))


@query(with_p(" UNION ALL ".join(
    f"""SELECT '{c}' AS feature, {c} AS value, round(avg(y), 6) AS mean, count(*) AS count,
               CAST(sum(y) AS BIGINT) AS positives, round(avg(y) * 100, 6) AS rate_pct FROM p GROUP BY {c}""" for c in CATS)))
def target_rates_all_levels(spark, folder):
    return rounded(rates.target_rates(frames.orders_frame(spark, folder, [*CATS, "y"]), CATS, "y"))


@query(f"""SELECT source, round(avg(toxic), 6) AS mean, count(*) AS count, CAST(sum(toxic) AS BIGINT) AS positives,
                  round(avg(toxic) * 100, 6) AS rate_pct FROM ({L}) GROUP BY 1""")
def target_rate_source(spark, folder):
    return rounded(rates.target_rate(frames.documents_frame(spark, folder), "source", "toxic"))


@query(with_p("""
  SELECT region, segment, CAST(sum(y) AS BIGINT) AS sum, count(*) AS count,
         round((sum(y) + 100 * (SELECT avg(y) FROM p)) / (count(*) + 100), 6) AS smoothed_rate,
         round(100 * (sum(y) + 100 * (SELECT avg(y) FROM p)) / (count(*) + 100), 6) AS rate_pct
  FROM p GROUP BY 1, 2"""))
def smoothed_rate(spark, folder):
    df = frames.orders_frame(spark, folder, ["region", "segment", "y"])
    return rounded(rates.smoothed_rate(df, ["region", "segment"], "y"))


_TABLE = """SELECT rich, urgency, avg(y) AS rate, count(*) AS n, CAST(sum(y) AS BIGINT) AS pos
            FROM p GROUP BY 1, 2 HAVING count(*) >= 100"""


@query(with_p(f"""SELECT rich, urgency, round(rate, 6) AS target_rate, n AS count, pos AS positives,
                         round(rate * 100, 6) AS target_rate_pct FROM ({_TABLE}) t"""))
def interaction_table(spark, folder):
    df = frames.orders_frame(spark, folder, ["rich", "urgency", "y"])
    return rounded(rates.interaction_table(df, "rich", "urgency", "y", MIN))


@query(with_p(f"""SELECT count(*) AS n_combinations, round(min(rate) * 100, 6) AS min_pct,
                         round(max(rate) * 100, 6) AS max_pct FROM ({_TABLE}) t"""))
def interaction_range(spark, folder):
    df = frames.orders_frame(spark, folder, ["rich", "urgency", "y"])
    return rounded(rates.interaction_range(rates.interaction_table(df, "rich", "urgency", "y", MIN)))


def spread_sql(head: str, keys: list[str], src: str, tail: str, minimum: int = MIN) -> str:
    names = ", ".join(keys)
    return (f"SELECT {head}, {tail} FROM (SELECT {names}, avg(y) AS rate, count(*) AS n FROM {src} "
            f"GROUP BY {names} HAVING count(*) >= {minimum}) g HAVING count(*) > 0")


RANGE_SQL = ("round(min(rate), 6) AS min_rate, round(max(rate), 6) AS max_rate, "
          "round(max(rate) - min(rate), 6) AS rate_range")
_STD = "round(sum(abs(rate - (SELECT avg(y) FROM p)) * n) / sum(n), 6) AS weighted_std"


@query(with_p(" UNION ALL ".join(
    spread_sql(f"'{a}' AS feature_1, '{b}' AS feature_2, count(*) AS n_combinations", [a, b], "p", f"{RANGE_SQL}, {_STD}")
    for a, b in combinations(CATS, 2))))
def pair_interactions(spark, folder):
    return rounded(rates.pair_interactions(frames.orders_frame(spark, folder, [*CATS, "y"]), CATS, "y", MIN))


@query(with_p(" UNION ALL ".join(
    spread_sql(f"'{' × '.join(t)}' AS features, count(*) AS n_groups", list(t), "p", RANGE_SQL)
    for t in combinations(CATS, 3))))
def triple_interactions(spark, folder):
    return rounded(rates.triple_interactions(frames.orders_frame(spark, folder, [*CATS, "y"]), CATS, "y", MIN))


@query(with_p(" UNION ALL ".join(
    f"""SELECT '{a} × {b}' AS features, count(*) AS n_combinations, min(n) AS min_count,
               median(CAST(n AS DOUBLE)) AS median_count, max(n) AS max_count
        FROM (SELECT {a}, {b}, count(*) AS n FROM p GROUP BY {a}, {b}) g""" for a, b in combinations(CATS, 2))))
def combo_frequencies(spark, folder):
    return rates.combo_frequencies(frames.orders_frame(spark, folder, CATS), CATS)


def profile_sql(src: str, col: str, q: int) -> str:
    return f"""
      SELECT bin, round(any_value(e[bin + 1]), 5) AS lo, round(any_value(e[bin + 2]), 5) AS hi,
             round(avg(y), 6) AS mean, count(*) AS count, round(avg(y) * 100, 6) AS rate_pct
      FROM (SELECT e, y, {bin_sql('e', col)} AS bin
            FROM (SELECT {col}, y, {edges_sql(src, col, q)} AS e FROM {src}) a) b
      GROUP BY bin"""


@query(with_p(profile_sql("p", "amount", 10)))
def numeric_profile_amount(spark, folder):
    df = frames.orders_frame(spark, folder, ["amount", "y"])
    return rounded(rates.numeric_profile(df, "amount", "y", 10), lo=5, hi=5)


@query(profile_sql("(SELECT value, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y FROM events)", "value", 10))
def numeric_profile_event_value(spark, folder):
    df = frames.events_frame(spark, folder)
    return rounded(rates.numeric_profile(df, "value", "y", 10), lo=5, hi=5)


@query(with_p(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", * FROM ({profile_sql('p', c, 10)}) t" for c in frames.NUMBERS)))
def numeric_profiles_all(spark, folder):
    df = flat(spark, folder, [*frames.NUMBERS, "y"])
    return rounded(rates.numeric_profiles(df, frames.NUMBERS, "y", 10), lo=5, hi=5)


_GRID_NUMS = frames.NUMBERS
_BINNED = ", ".join(f"{bin_sql('e_' + c, c)} AS {c}_bin" for c in _GRID_NUMS)
_EDGES = ", ".join(f"{edges_sql('p', c, 5)} AS e_{c}" for c in _GRID_NUMS)


@query(with_p(f", b AS (SELECT *, {_BINNED} FROM (SELECT p.*, {_EDGES} FROM p) a) ".join(["", " UNION ALL ".join(
    spread_sql(f"'{n}' AS numerical, '{c}' AS categorical", [f"{n}_bin", c], "b", RANGE_SQL)
    for n in _GRID_NUMS for c in CATS)])))
def numeric_cat_interactions(spark, folder):
    df = flat(spark, folder, [*_GRID_NUMS, *CATS, "y"])
    grid = rates.numeric_cat_interactions(df, _GRID_NUMS, CATS, "y", 5, MIN)
    return rounded(grid)


_MOD_COLS = ["nation", "qty", "n_lines", "balance"]


def _floor_mod(c: str, m: int) -> str:
    """Remainder with the sign of the modulus. Adding the modulus to a positive remainder too would round it."""
    r = f"(CAST({c} AS DOUBLE) % {m})"
    return f"(CASE WHEN {r} < 0 THEN {r} + {m} ELSE {r} END)"


@query(with_p(" UNION ALL ".join(
    f"""SELECT '{c}' AS feature, 'mod_{m}' AS operation,
               round(max(abs(rate - (SELECT avg(y) FROM p))), 6) AS max_deviation,
               round(sum(rate * n) / sum(n), 6) AS weighted_rate, count(*) AS n_groups
        FROM (SELECT {_floor_mod(c, m)} AS v, avg(y) AS rate, count(*) AS n FROM p
              GROUP BY 1 HAVING count(*) >= 20) g HAVING count(*) > 0""" for c in _MOD_COLS for m in MODS)))
def modulo_audit(spark, folder):
    df = frames.orders_frame(spark, folder, [*_MOD_COLS, "y"])
    return rounded(rates.modulo_audit(df, _MOD_COLS, MODS, "y", 20))


@query(with_p(" UNION ALL ".join(
    f"""SELECT '{c}' AS feature, CAST({m} AS INTEGER) AS mod, count(*) AS n_groups,
               max(abs(r)) AS max_abs_mean_residual
        FROM (SELECT {_floor_mod(c, m)} AS v, sum(y - score_d) / count(*) AS r FROM p GROUP BY 1) g"""
    for c in ("nation", "qty", "n_lines") for m in MODS)))
def modulo_residual_audit(spark, folder):
    df = frames.orders_frame(spark, folder, ["nation", "qty", "n_lines", "y", "score_d"])
    return rates.modulo_residual_audit(df, ["nation", "qty", "n_lines"], MODS, "y", "score_d")


@query(with_p(" UNION ALL ".join(
    f"""SELECT 'qty' AS feature, CAST({m} AS INTEGER) AS mod, v AS value, count(*) AS n,
               sum(y) / CAST(count(*) AS DOUBLE) AS target_rate, sum(score_d) / count(*) AS mean_prediction,
               sum(y - score_d) / count(*) + 0.0 AS mean_residual, abs(sum(y - score_d) / count(*)) AS residual_abs
        FROM (SELECT *, {_floor_mod('qty', m)} AS v FROM p) g GROUP BY v""" for m in MODS)))
def modulo_residual_groups(spark, folder):
    df = frames.orders_frame(spark, folder, ["qty", "y", "score_d"])
    return rates.modulo_residuals(df, ["qty"], MODS, "y", "score_d")


@query(ORACLES["target_rate_region"])
def report_round_trip(spark, folder):
    """A result table written as a text report and read back with its types."""
    df = rounded(rates.target_rate(frames.orders_frame(spark, folder, ["region", "y"]), "region", "y"))
    return rounded(files.read_back(spark, files.write_report(df, work_folder(spark, "report")), df.schema))
