"""SQL text of the analog, silver and gold views, composed into one ``WITH`` clause.

This is the independent oracle: DuckDB runs it on the same parquet tables, and the result
must equal the DataFrame operators'. Views are resolved by name with their dependencies.
"""

from __future__ import annotations

from sparkplate.sources.analogs import SQL_VIEWS


def round_sql(expr: str, digits: int, guard: int = 13) -> str:
    """Half-up rounding of a double in SQL: ``guard`` decimals are exact for the values here."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,{guard})), {digits}) AS DOUBLE)"


def month_sql(expr: str) -> str:
    return f"CAST(date_trunc('month', TRY_CAST({expr} AS TIMESTAMP)) AS DATE)"


VIEWS: dict[str, tuple[str, list[str]]] = {name: (sql, []) for name, sql in SQL_VIEWS.items()}

VIEWS["dim_user"] = ("""SELECT user_id, name AS user_name, average_stars, review_count, funny, cool, fans, friends,
  compliment_cool, compliment_cute, compliment_funny, compliment_hot, compliment_list, compliment_more,
  compliment_note, compliment_photos, compliment_plain, compliment_profile, compliment_writer
FROM an_user""", ["an_user"])
VIEWS["dim_restaurant"] = ("""SELECT business_id AS restaurant_id, name AS restaurant_name, categories, city,
  address, is_open, latitude, longitude, postal_code, review_count, stars, state, hours_monday, hours_tuesday, hours_wednesday, hours_thursday,
  hours_friday, hours_saturday, hours_sunday
FROM an_restaurant""", ["an_restaurant"])
VIEWS["fact_review"] = ("""SELECT review_id, business_id AS restaurant_id, user_id, stars, cool, funny, useful,
  CAST(date AS VARCHAR) AS review_date, text AS review_description
FROM an_review""", ["an_review"])
VIEWS["analyses_review"] = ("""SELECT fr.*, dr.restaurant_name, dr.categories, dr.city, dr.latitude, dr.longitude,
  dr.stars AS restaurant_stars, dr.state, dr.review_count,
  dr.hours_monday, dr.hours_tuesday, dr.hours_wednesday, dr.hours_thursday, dr.hours_friday, dr.hours_saturday, dr.hours_sunday,
  du.user_name
FROM fact_review fr
LEFT JOIN dim_restaurant dr ON fr.restaurant_id = dr.restaurant_id
LEFT JOIN dim_user du ON fr.user_id = du.user_id""", ["fact_review", "dim_restaurant", "dim_user"])


def register(name: str, sql: str, deps: list[str]) -> None:
    VIEWS[name] = (sql, deps)


def with_views(body: str, *names: str) -> str:
    """``WITH`` the named views (and what they need, in dependency order) then ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in VIEWS[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n][0]}\n)" for n in order)
    if body.lstrip().upper().startswith("WITH "):  # merge the body's own CTEs into one clause
        return f"WITH {ctes},\n{body.lstrip()[5:]}"
    return f"WITH {ctes}\n{body}"
