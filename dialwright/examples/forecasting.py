"""Feature tables, training and scoring."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from dialwright import fixed_values as fv
from dialwright.examples import base
from dialwright.examples.registry import cte, query
from dialwright.functions.keys import floor_minutes
from dialwright.operators.occupancy import occupancy
from dialwright.plans import features, forecast
from dialwright.plans.silver import synthetic_forecast

_NAMES = list(fv.FORECAST_FEATURES.values())


def forecasts(spark, sf_dir):
    mean = synthetic_forecast(base.raw_forecasts(spark, sf_dir), ["North", "South"], base.SYNTHETIC_SITE)
    return mean.select(
        F.col("Time").alias("ts"),
        F.col("Measurement").alias("measure"),
        F.col("Prediction").try_cast("int").alias("horizon"),
        F.col("Value").alias("value"),
    )


def weather(spark, sf_dir, fill="last"):
    return features.weather_features(forecasts(spark, sf_dir), fill=fill)


cte(
    "weather_wide",
    """SELECT "Time" AS ts, """
    + ", ".join(
        f"""avg("Value") FILTER (WHERE "Measurement" = '{code}') AS {name}""" for code, name in fv.FORECAST_FEATURES.items()
    )
    + """ FROM (SELECT * FROM {forecasts} WHERE "Value" IS NOT NULL
         QUALIFY row_number() OVER (PARTITION BY "Time", "Measurement" ORDER BY CAST("Prediction" AS INTEGER)) = 1)
       GROUP BY 1""",
)
cte(
    "weather_grid",
    """SELECT ts, w.* EXCLUDE (ts) FROM (SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 15 MINUTE)) AS ts
       FROM {weather_wide}) LEFT JOIN {weather_wide} w USING (ts)""",
)
_FRAME = "OVER (ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
cte(
    "weather",
    "SELECT * FROM (SELECT ts, "
    + ", ".join(f"last_value({n} IGNORE NULLS) {_FRAME} AS {n}" for n in _NAMES)
    + " FROM {weather_grid}) WHERE irradiance_wm2 IS NOT NULL",
)


def _rounded(df):
    return df.withColumns({n: F.round(n, 6) for n in _NAMES if n in df.columns})


@query("weather_features", "SELECT ts, " + ", ".join(f"round({n}, 6) AS {n}" for n in _NAMES) + " FROM {weather}")
def weather_features(spark, sf_dir):
    return _rounded(weather(spark, sf_dir))


@query(
    "weather_features_mean",
    "SELECT ts, "
    + ", ".join(f"round({n}, 4) AS {n}" for n in _NAMES)
    + " FROM (SELECT ts, "
    + ", ".join(f"avg({n}) {_FRAME} AS {n}" for n in _NAMES)
    + " FROM {weather_grid}) WHERE irradiance_wm2 IS NOT NULL",
)
def weather_features_mean(spark, sf_dir):
    return weather(spark, sf_dir, "running_mean").withColumns({n: F.round(n, 4) for n in _NAMES})


_TIME_SQL = {
    "hour": "hour(ts)",
    "minute": "minute(ts)",
    "month": "month(ts)",
    "day_of_week": "dayofweek(ts) + 1",
    "is_weekend": "CAST(dayofweek(ts) IN (0, 6) AS INTEGER)",
    "is_academic_day": "CAST(dayofweek(ts) NOT IN (0, 6) AS INTEGER)",
    "quarter_hour": "hour(ts) * 4 + minute(ts) // 15",
}


def _feature_sql(names: list[str]) -> str:
    return ", ".join(f"{_TIME_SQL[n]} AS {n}" if n in _TIME_SQL else f"round({n}, 6) AS {n}" for n in names)


def _energy(spark, sf_dir, event_type):
    return base.slot_energy(spark, sf_dir, event_type).withColumnRenamed("delta", "delta_kwh")


def solar(spark, sf_dir):
    return features.solar_features(_energy(spark, sf_dir, "signup"), weather(spark, sf_dir))


@query(
    "solar_features",
    f"""SELECT ts, {_feature_sql(features.SOLAR_FEATURES)}, delta_kwh AS production_delta_kwh
        FROM {{production}} JOIN {{weather}} USING (ts) WHERE irradiance_wm2 IS NOT NULL AND temp_c IS NOT NULL""",
)
def solar_features(spark, sf_dir):
    return _rounded(solar(spark, sf_dir))


def event_bookings(spark, sf_dir):
    """Bookings in the same weeks as the readings: every error event books a room."""
    events = base.table(spark, sf_dir, "events").filter("event_type = 'error'")
    start = floor_minutes("ts", 15)
    length = F.make_dt_interval(F.lit(0), F.lit(0), (15 * (1 + F.col("event_id") % 8)).cast("int"))
    return events.select((F.col("user_id") % 40).alias("room"), start.alias("start_at"), (start + length).alias("end_at"))


cte(
    "event_occupation",
    """SELECT slot AS ts, count(DISTINCT room) / (SELECT count(DISTINCT user_id % 40) FROM events WHERE event_type = 'error')
         AS room_occupation_pct FROM (
         SELECT user_id % 40 AS room, unnest(generate_series(time_bucket(INTERVAL 15 MINUTE, ts),
           time_bucket(INTERVAL 15 MINUTE, ts) + to_minutes(CAST(15 * (event_id % 8) AS INTEGER)), INTERVAL 15 MINUTE)) AS slot
         FROM events WHERE event_type = 'error') GROUP BY slot""",
)


def consuming(spark, sf_dir):
    rooms = occupancy(event_bookings(spark, sf_dir), "room", "start_at", "end_at")
    return features.consumption_features(_energy(spark, sf_dir, "purchase"), weather(spark, sf_dir), rooms)


@query(
    "consumption_features",
    f"""SELECT ts, {_feature_sql(features.CONSUMPTION_FEATURES).replace("round(room_occupation_pct, 6)", "round(coalesce(room_occupation_pct, 0.0), 6)")},
        delta_kwh AS consumption_delta_kwh
        FROM {{consumption}} JOIN {{weather}} USING (ts) LEFT JOIN {{event_occupation}} USING (ts)
        WHERE temp_c IS NOT NULL AND humidity_pct IS NOT NULL""",
)
def consumption_features(spark, sf_dir):
    rows = _rounded(consuming(spark, sf_dir))
    return rows.withColumn("room_occupation_pct", F.round("room_occupation_pct", 6))


@query("time_split", "SELECT event_id, ts >= TIMESTAMP '2024-01-25' AS is_test FROM events")
def time_split(spark, sf_dir):
    train, test = forecast.time_split(base.table(spark, sf_dir, "events"), "ts", "2024-01-24")
    tagged = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
    return tagged.select("event_id", "is_test")


@query(
    "gbt_forecast",
    """SELECT ts, delta_kwh AS production_delta_kwh, true AS has_prediction, true AS not_negative
        FROM {production} JOIN {weather} USING (ts)
        WHERE irradiance_wm2 IS NOT NULL AND temp_c IS NOT NULL AND ts >= TIMESTAMP '2024-01-25'""",
)
def gbt_forecast(spark, sf_dir):
    """Boosted trees trained on the first days; every later row is scored."""
    train, test = forecast.time_split(solar(spark, sf_dir), "ts", "2024-01-24")
    model = forecast.train_gbt(train, features.SOLAR_FEATURES, "production_delta_kwh")
    scored = forecast.predict(model, test, "predicted_production_kwh")
    made = F.col("predicted_production_kwh")
    return scored.select(
        "ts", "production_delta_kwh", made.isNotNull().alias("has_prediction"), (made >= 0).alias("not_negative")
    )


cte(
    "solar_rows",
    """SELECT ts, delta_kwh AS y FROM {production} JOIN {weather} USING (ts)
       WHERE irradiance_wm2 IS NOT NULL AND temp_c IS NOT NULL""",
)
cte(
    "naive_rows",
    """SELECT a.ts, a.y, p.y AS naive, (SELECT avg(y) FROM {solar_rows} WHERE ts < TIMESTAMP '2024-01-25') AS mean
       FROM {solar_rows} a ASOF LEFT JOIN {solar_rows} p ON a.ts - INTERVAL 1 DAY >= p.ts""",
)


@query("seasonal_naive", "SELECT ts, y AS production_delta_kwh, naive FROM {naive_rows}")
def seasonal_naive(spark, sf_dir):
    rows = solar(spark, sf_dir).select("ts", "production_delta_kwh")
    return forecast.seasonal_naive(rows, "production_delta_kwh")


@query(
    "forecast_skill",
    """SELECT n_scored, round(naive_rmse, 4) AS naive_rmse, round(mean_rmse, 4) AS mean_rmse,
              round(1 - mean_rmse / nullif(naive_rmse, 0), 6) AS mean_skill
       FROM (SELECT count(*) AS n_scored, sqrt(avg(power(naive - y, 2))) AS naive_rmse, sqrt(avg(power(mean - y, 2))) AS mean_rmse
             FROM {naive_rows} WHERE ts >= TIMESTAMP '2024-01-25' AND naive IS NOT NULL)""",
)
def forecast_skill(spark, sf_dir):
    """Errors of the two yardsticks that any model has to beat: yesterday's value and the training mean."""
    target = "production_delta_kwh"
    train, test = forecast.time_split(forecast.seasonal_naive(solar(spark, sf_dir), target), "ts", "2024-01-24")
    scored = test.withColumn("mean", train.agg(F.avg(target).alias("mean")).scalar())
    found = forecast.skill(scored, target, ["mean"], against="naive")
    return found.select(
        "n_scored",
        F.round("naive_rmse", 4).alias("naive_rmse"),
        F.round("mean_rmse", 4).alias("mean_rmse"),
        F.round("mean_skill", 6).alias("mean_skill"),
    )


@query(
    "model_selection",
    """SELECT algorithm, true AS has_error, CAST(1 AS BIGINT) AS n_best, true AS best_is_lowest
       FROM (VALUES ('decision_tree'), ('gradient_boosted_trees'), ('linear_regression'), ('random_forest')) t(algorithm)
       WHERE (SELECT count(*) FROM events) > 0""",
)
def model_selection(spark, sf_dir):
    """Four regressors judged forward in time on the consumption features: one winner, with the lowest error."""
    scores, _ = forecast.select_model(
        consuming(spark, sf_dir), features.CONSUMPTION_FEATURES, "consumption_delta_kwh"
    )
    whole = Window.partitionBy(F.lit(1))  # four rows
    lowest = F.min("rmse").over(whole)
    best = F.min(F.when(F.col("is_best"), F.col("rmse"))).over(whole)
    return scores.select(
        "algorithm",
        (F.col("rmse") >= 0).alias("has_error"),
        F.count_if("is_best").over(whole).alias("n_best"),
        (best == lowest).alias("best_is_lowest"),
    )
