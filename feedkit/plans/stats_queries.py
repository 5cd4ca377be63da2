"""Queries for least squares."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedkit.operators.stats import forecast, load_model, ols_fit, save_model
from feedkit.plans.registry import query
from feedkit.plans.views import table
from feedkit.session import fresh_path


def _rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "ols_fit",
    """SELECT 'l_quantity' AS variable, round(regr_slope(l_extendedprice, l_quantity), 6) AS beta FROM lineitem
       UNION ALL SELECT 'intercept' AS variable, round(regr_intercept(l_extendedprice, l_quantity), 6) AS beta
       FROM lineitem""",
)
def _(spark, sf):
    model = ols_fit(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", min_obs=100, intcp=1)
    return _rounded(model.table(spark).select("variable", "beta"), "beta")


@query(
    "ols_fit_origin",
    """SELECT 'l_quantity' AS variable,
              round(sum(l_quantity * l_extendedprice) / sum(l_quantity * l_quantity), 6) AS beta FROM lineitem
       UNION ALL SELECT 'intercept' AS variable, CAST(0 AS DOUBLE) AS beta""",
)
def _(spark, sf):
    model = ols_fit(table(spark, sf, "lineitem"), ["l_quantity"], ["l_extendedprice"])
    return _rounded(model.table(spark).select("variable", "beta"), "beta")


@query(
    "ols_fit_two",
    """WITH c AS (SELECT covar_pop(l_quantity, l_quantity) AS aa, covar_pop(l_tax, l_tax) AS bb,
                         covar_pop(l_quantity, l_tax) AS ab, covar_pop(l_quantity, l_extendedprice) AS ay,
                         covar_pop(l_tax, l_extendedprice) AS by_, avg(l_quantity) AS ma, avg(l_tax) AS mb,
                         avg(l_extendedprice) AS my FROM lineitem),
            b AS (SELECT (ay * bb - by_ * ab) / (aa * bb - ab * ab) AS b1,
                         (by_ * aa - ay * ab) / (aa * bb - ab * ab) AS b2, * FROM c)
       SELECT 'l_quantity' AS variable, round(b1, 4) AS beta FROM b
       UNION ALL SELECT 'l_tax' AS variable, round(b2, 4) AS beta FROM b
       UNION ALL SELECT 'intercept' AS variable, round(my - b1 * ma - b2 * mb, 4) AS beta FROM b""",
)
def _(spark, sf):
    model = ols_fit(table(spark, sf, "lineitem"), ["l_quantity", "l_tax"], "l_extendedprice", intcp=1)
    return _rounded(model.table(spark).select("variable", "beta"), "beta", digits=4)


@query("ols_min_obs", "SELECT count(*) AS observations FROM lineitem WHERE l_tax IS NOT NULL AND l_quantity IS NOT NULL")
def _(spark, sf):
    items = table(spark, sf, "lineitem")
    model = ols_fit(items, "l_tax", "l_quantity", min_obs=1000, intcp=1)
    return spark.createDataFrame([(model.observations,)], "observations long")


@query(
    "ols_params",
    """SELECT form, round(regr_slope(l_extendedprice, l_quantity), 6) AS beta
       FROM lineitem, (SELECT unnest(['text', 'list']) AS form) GROUP BY form""",
)
def _(spark, sf):
    items = table(spark, sf, "lineitem")
    forms = {"text": ("l_quantity", "l_extendedprice"), "list": (["l_quantity"], ["l_extendedprice"])}
    betas = [(form, ols_fit(items, x, y, intcp=1).beta[0]) for form, (x, y) in forms.items()]
    return _rounded(spark.createDataFrame(betas, "form string, beta double"), "beta")


_ERRORS = """s AS (SELECT count(*) AS n, regr_slope(l_extendedprice, l_quantity) AS b1,
        regr_intercept(l_extendedprice, l_quantity) AS b0, regr_sxx(l_extendedprice, l_quantity) AS sxx,
        regr_syy(l_extendedprice, l_quantity) AS syy, regr_sxy(l_extendedprice, l_quantity) AS sxy,
        avg(l_quantity) AS mx FROM lineitem),
    e AS (SELECT *, sqrt((syy - b1 * sxy) / (n - 2) / sxx) AS se1,
                 sqrt((syy - b1 * sxy) / (n - 2) * (1.0 / n + mx * mx / sxx)) AS se0 FROM s)"""
_TABLE = f"""WITH {_ERRORS}
    SELECT 'l_quantity' AS variable, round(b1, 5) AS beta, round(se1, 5) AS stderr, round(b1 / se1, 5) AS t_value FROM e
    UNION ALL SELECT 'intercept', round(b0, 5), round(se0, 5), round(b0 / se0, 5) FROM e"""


def _price_model(spark, sf):
    return ols_fit(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", intcp=1)


# Two-sided p of Student's t with v degrees of freedom: one less twice the density from 0 to |t|, by Simpson's rule.
_P_VALUES = f"""WITH {_ERRORS}, t AS (
        SELECT 'l_quantity' AS variable, b1 AS b, se1 AS se, b1 / se1 AS t, n - 2 AS v FROM e
        UNION ALL SELECT 'intercept', b0, se0, b0 / se0, n - 2 FROM e),
    grid AS (SELECT *, least(abs(t), 60) / 4000 AS h, i * least(abs(t), 60) / 4000 AS x,
                    CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w FROM t, range(0, 4001) r(i)),
    area AS (SELECT variable, any_value(b) AS b, any_value(se) AS se, any_value(t) AS t,
                    sum(w * h / 3 * exp(lgamma((v + 1) / 2) - lgamma(v / 2)) / sqrt(v * pi())
                        * pow(1 + x * x / v, -(v + 1) / 2)) AS half FROM grid GROUP BY variable)
    SELECT variable, round(b, 5) AS beta, round(se, 5) AS stderr, round(t, 5) AS t_value,
           round(greatest(1 - 2 * half, 0), 6) AS prob_t FROM area"""


@query("ols_table", _P_VALUES)
def _(spark, sf):
    model = _price_model(spark, sf).table(spark).withColumn("prob_t", F.round("prob_t", 6))
    return _rounded(model, "beta", "stderr", "t_value", digits=5)


@query("ols_pvalues")
def _(spark, sf):
    model = ols_fit(table(spark, sf, "lineitem"), ["l_quantity", "l_tax", "l_discount"], "l_extendedprice", intcp=1)
    return model.table(spark)


@query(
    "ols_forecast",
    f"""WITH {_ERRORS} SELECT l_orderkey, l_linenumber,
        round((b0 + 1.5 * se0) + (b1 + 1.5 * se1) * l_quantity, 3) AS forecast FROM lineitem, e""",
)
def _(spark, sf):
    items = table(spark, sf, "lineitem")
    predicted = forecast(_price_model(spark, sf), items.columns, sigma=1.5)
    return items.select("l_orderkey", "l_linenumber", F.round(predicted, 3).alias("forecast"))


@query(
    "ols_forecast_saved",
    f"""WITH {_ERRORS} SELECT l_orderkey, l_linenumber,
        round((b0 - 0.5 * se0) + (b1 - 0.5 * se1) * l_quantity, 3) AS forecast FROM lineitem, e""",
)
def _(spark, sf):
    path = save_model(spark, _price_model(spark, sf), fresh_path(spark, "model"), force_dir=True)
    items = table(spark, sf, "lineitem")
    predicted = forecast(load_model(spark, path), items.columns, sigma=-0.5)
    return items.select("l_orderkey", "l_linenumber", F.round(predicted, 3).alias("forecast"))


@query("ols_save", _TABLE)
def _(spark, sf):
    path = save_model(spark, _price_model(spark, sf), fresh_path(spark, "model"), force_dir=True)
    numbers = ["beta", "stderr", "t_value"]
    return _rounded(spark.read.parquet(path).select("variable", *numbers), *numbers, digits=5)
