"""Marts over the star schema derived from events and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialwright.examples import base
from dialwright.examples.registry import cte, query
from dialwright.operators import dimensions, joins
from dialwright.operators.dimensions import dim_time
from dialwright.plans import facts, marts
from dialwright.plans.silver import synthetic_forecast
from dialwright.session import local_frame

cte(
    "breakdown",
    """SELECT full_date, year, month, month_name, unit_id, unit_name, status_code, status_label, status_category,
       s.is_failure, reading_count,
       CAST(round(100.0 * reading_count / sum(reading_count) OVER (PARTITION BY full_date, unit_id), 2) AS DOUBLE)
         AS pct_of_day_readings
       FROM (SELECT date_key, unit_id, status_code, count(*) AS reading_count FROM {device} GROUP BY ALL)
       JOIN {event_days} USING (date_key) JOIN {unit_dim} USING (unit_id) JOIN {status_dim} s USING (status_code)""",
)
cte(
    "performance",
    """SELECT unit_id, full_date,
       CAST(round(sum(ac_power_w) / (6000.0 * count(*)), 6) AS DOUBLE) AS performance_ratio,
       CAST(max(CAST(is_failure AS INTEGER)) AS INTEGER) AS had_failure
       FROM {device} JOIN {event_days} USING (date_key) GROUP BY unit_id, full_date""",
)


def breakdown(spark, sf_dir):
    rows, units, statuses = base.device(spark, sf_dir)
    return marts.status_breakdown(rows, base.days_of_events(spark, sf_dir), units, statuses)


def performance(spark, sf_dir):
    rows, units, _ = base.device(spark, sf_dir)
    return marts.unit_performance(rows, base.days_of_events(spark, sf_dir), units)


query("status_breakdown", "SELECT * FROM {breakdown}")(breakdown)
query("unit_performance", "SELECT * FROM {performance}")(performance)


@query(
    "energy_balance",
    """SELECT full_date, year, month, month_name, quarter, is_weekend, is_academic_day, season,
       coalesce(made, 0) AS total_production_kwh, coalesce(used, 0) AS total_consumption_kwh,
       coalesce(used, 0) - coalesce(made, 0) AS net_consumption_kwh,
       coalesce(used, 0) * CAST(0.15 AS DOUBLE) AS total_cost,
       coalesce(made, 0) * CAST(0.15 AS DOUBLE) AS total_production_value,
       CASE WHEN coalesce(used, 0) > 0 THEN coalesce(made, 0) / used ELSE 0 END AS self_sufficiency_ratio
       FROM {event_days}
       LEFT JOIN (SELECT date_key, sum(delta_kwh) AS made FROM {production} GROUP BY 1) USING (date_key)
       LEFT JOIN (SELECT date_key, sum(delta_kwh) AS used FROM {consumption} GROUP BY 1) USING (date_key)""",
)
def energy_balance(spark, sf_dir):
    return marts.daily_energy_balance(
        base.days_of_events(spark, sf_dir), base.production(spark, sf_dir), base.consumption(spark, sf_dir)
    )


cte(
    "occupation",
    """SELECT full_date, year, month, month_name, week_of_year, day_name, is_weekend, is_academic_day,
       room_code, floor, wing, room_type, school_name, division_code,
       coalesce(booking_count, 0) AS booking_count, CAST(coalesce(minutes, 0) AS BIGINT) AS total_booked_minutes,
       CAST(coalesce(minutes, 0) AS DOUBLE) * 100.0 / 720.0 AS occupation_pct,
       lpad(CAST(first // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(first % 60 AS VARCHAR), 2, '0')
         AS earliest_booking_time,
       lpad(CAST(last // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(last % 60 AS VARCHAR), 2, '0')
         AS latest_booking_time
       FROM (SELECT * FROM {order_days} WHERE is_academic_day) CROSS JOIN {room_dim}
       LEFT JOIN (SELECT date_key, room_code, division_name, count(*) AS booking_count,
                         sum(duration_minutes) AS minutes, min(start_time_key) AS first, max(end_time_key) AS last
                  FROM {booking_fact} GROUP BY ALL) USING (date_key, room_code)
       LEFT JOIN {division_dim} USING (division_name)""",
)


def occupation(spark, sf_dir):
    rows, rooms, divisions = base.booking_fact(spark, sf_dir)
    return marts.building_occupation(base.days_of_orders(spark, sf_dir), rooms, rows, divisions, dim_time(spark))


query("building_occupation", "SELECT * FROM {occupation}")(occupation)


def _kpi_sql(slots_join: str) -> str:
    return f"""SELECT full_date, year, month, time_key,
       coalesce(c.delta_kwh, 0) * CAST(0.15 AS DOUBLE) AS consumption_cost,
       coalesce(c.delta_kwh, 0) AS consumption_kwh, coalesce(p.delta_kwh, 0) AS production_kwh,
       temperature_c, humidity_pct, total_readings, failure_readings,
       CASE WHEN total_readings > 0 THEN failure_readings * 100.0 / total_readings ELSE 0 END
         AS panel_failure_rate_pct
       FROM {{event_days}}
       LEFT JOIN ({{consumption}} c {slots_join} JOIN {{production}} p USING (date_key, time_key)
                  LEFT JOIN {{environment}} e USING (date_key, time_key)) USING (date_key)
       LEFT JOIN (SELECT date_key, count(*) AS total_readings,
                         CAST(count(*) FILTER (WHERE is_failure) AS BIGINT) AS failure_readings
                  FROM {{device}} GROUP BY 1) USING (date_key)"""


def _kpi(spark, sf_dir, all_slots):
    return marts.kpi_home(
        base.days_of_events(spark, sf_dir),
        base.consumption(spark, sf_dir),
        base.production(spark, sf_dir),
        base.environment(spark, sf_dir),
        base.device(spark, sf_dir)[0],
        all_slots=all_slots,
    )


@query("kpi_home", _kpi_sql("LEFT"))
def kpi_home(spark, sf_dir):
    return _kpi(spark, sf_dir, all_slots=False)


@query("kpi_home_all_slots", _kpi_sql("FULL"))
def kpi_home_all_slots(spark, sf_dir):
    return _kpi(spark, sf_dir, all_slots=True)


@base.layer
def forecast_parts(spark, sf_dir):
    """Forecast fact with its site and measure dimensions."""
    raw = base.raw_forecasts(spark, sf_dir)
    silver = base.stored(synthetic_forecast(raw, ["North", "South"], base.SYNTHETIC_SITE), "silver-forecasts")
    sites = dimensions.load_sites(
        local_frame(spark, [], base.SITE_SCHEMA), raw, "Site", base.site_meta(spark), [base.SYNTHETIC_SITE]
    )
    measures = dimensions.load_measures(
        local_frame(spark, [], base.MEASURE_SCHEMA), raw, "Measurement", "Unit", base.measure_meta(spark)
    )
    rows, _ = facts.forecast_fact(silver, sites, measures)
    return rows, sites, measures


cte(
    "forecast_fact",
    """SELECT CAST(strftime("Time", '%Y%m%d') AS INTEGER) AS date_key, CAST(hour("Time") * 60 AS INTEGER) AS time_key,
       "Site" AS site_name, "Measurement" AS measure_code, CAST("Prediction" AS INTEGER) AS horizon,
       "Value" AS forecast_value FROM {forecasts}""",
)


def _nearest(measure: str, name: str) -> str:
    return f"""LEFT JOIN (SELECT date_key, time_key, arg_min(forecast_value, horizon) AS {name} FROM {{forecast_fact}}
       WHERE measure_code = '{measure}' AND forecast_value IS NOT NULL AND abs(forecast_value) <> 99999.0
       GROUP BY 1, 2) USING (date_key, time_key)"""


@query(
    "weather_vs_production",
    f"""SELECT full_date, year, month, CAST(time_key // 60 AS INTEGER) AS hour,
       CAST(time_key // 15 AS INTEGER) AS quarter_hour_slot, p.delta_kwh AS actual_production_kwh, p.cumulative_kwh,
       round(irradiance_wm2, 6) AS irradiance_wm2, round(forecast_temp_c, 6) AS forecast_temp_c,
       temperature_c AS actual_indoor_temp_c, humidity_pct AS actual_humidity_pct
       FROM (SELECT *, CAST(unnest(generate_series(0, 1439)) AS INTEGER) AS time_key FROM {{event_days}})
       LEFT JOIN {{production}} p USING (date_key, time_key)
       LEFT JOIN {{environment}} e USING (date_key, time_key)
       {_nearest("PRED_GLOB_ctrl", "irradiance_wm2")} {_nearest("PRED_T_2M_ctrl", "forecast_temp_c")}""",
)
def weather_vs_production(spark, sf_dir):
    rows, sites, measures = forecast_parts(spark, sf_dir)
    result = marts.weather_vs_production(
        base.days_of_events(spark, sf_dir),
        base.production(spark, sf_dir),
        base.environment(spark, sf_dir),
        rows,
        joins.scalar_lookup(sites, "site_key", F.col("site_name") == base.SYNTHETIC_SITE),
        joins.scalar_lookup(measures, "measure_key", F.col("measure_code") == "PRED_GLOB_ctrl"),
        joins.scalar_lookup(measures, "measure_key", F.col("measure_code") == "PRED_T_2M_ctrl"),
    )
    return result.withColumns({c: F.round(c, 6) for c in ("irradiance_wm2", "forecast_temp_c")})


MODELS = [("MADE_V1", "Production forecast"), ("USED_V1", "Consumption forecast")]


def model_dim(spark):
    rows = [(i + 1, code, name, "GradientBoostedTrees") for i, (code, name) in enumerate(MODELS)]
    return local_frame(spark, rows, base.MODEL_SCHEMA)


def predicted(spark, sf_dir, event_type):
    """A forecast per slot that misses the true energy by a few per cent."""
    energy = base.slot_energy(spark, sf_dir, event_type)
    return energy.select("ts", F.floor(F.col("delta") * (90 + F.col("reading") % 20) / 100).cast("double").alias("value"))


def prediction_rows(spark, sf_dir):
    models = model_dim(spark)
    kinds = [
        (predicted(spark, sf_dir, "signup"), "MADE_V1", "predicted_production_kwh"),
        (predicted(spark, sf_dir, "purchase"), "USED_V1", "predicted_consumption_kwh"),
    ]
    rows, _ = facts.prediction_fact(kinds, models, 20240131)
    return rows, models


def _predicted_sql(source: str, model: str) -> str:
    made = "floor(delta_kwh * (90 + cumulative_kwh % 20) / 100)"
    first, second = (made, "NULL") if model == "MADE_V1" else ("NULL", made)
    return f"""SELECT date_key, time_key, '{model}' AS model_code, 20240131 AS run_date_key,
       CAST({first} AS DOUBLE) AS predicted_production_kwh, CAST({second} AS DOUBLE) AS predicted_consumption_kwh
       FROM {{{source}}}"""


cte(
    "prediction_rows",
    _predicted_sql("production", "MADE_V1") + " UNION ALL " + _predicted_sql("consumption", "USED_V1"),
)
cte(
    "backfilled",
    """SELECT r.*, p.delta_kwh AS actual_production_kwh, c.delta_kwh AS actual_consumption_kwh
       FROM {prediction_rows} r LEFT JOIN {production} p USING (date_key, time_key)
       LEFT JOIN {consumption} c USING (date_key, time_key)""",
)


@base.layer
def backfilled(spark, sf_dir):
    rows, models = prediction_rows(spark, sf_dir)
    return facts.backfill_actuals(rows, base.production(spark, sf_dir), base.consumption(spark, sf_dir)), models


@query(
    "prediction_fact",
    """SELECT *, CAST(NULL AS DOUBLE) AS actual_production_kwh, CAST(NULL AS DOUBLE) AS actual_consumption_kwh
       FROM {prediction_rows}""",
)
def prediction_fact(spark, sf_dir):
    rows, models = prediction_rows(spark, sf_dir)
    return rows.join(models.select("model_key", "model_code"), "model_key").drop("model_key")


@query("backfill_actuals", "SELECT * FROM {backfilled}")
def backfill_actuals(spark, sf_dir):
    rows, models = backfilled(spark, sf_dir)
    return rows.join(models.select("model_key", "model_code"), "model_key").drop("model_key")


@query(
    "prediction_accuracy",
    """SELECT full_date, model_code,
       CASE model_code WHEN 'MADE_V1' THEN 'Production forecast' ELSE 'Consumption forecast' END AS model_name,
       run_date_key,
       sum(predicted_production_kwh) AS predicted_production_kwh, sum(actual_production_kwh) AS actual_production_kwh,
       sum(predicted_consumption_kwh) AS predicted_consumption_kwh,
       sum(actual_consumption_kwh) AS actual_consumption_kwh,
       round(sum(abs(predicted_production_kwh - actual_production_kwh)) / nullif(sum(actual_production_kwh), 0), 6)
         AS production_wape,
       round(sum(abs(predicted_consumption_kwh - actual_consumption_kwh)) / nullif(sum(actual_consumption_kwh), 0), 6)
         AS consumption_wape
       FROM {backfilled} JOIN {event_days} USING (date_key) GROUP BY full_date, model_code, run_date_key""",
)
def prediction_accuracy(spark, sf_dir):
    rows, models = backfilled(spark, sf_dir)
    return marts.prediction_accuracy(rows, base.days_of_events(spark, sf_dir), models)


cte(
    "export",
    """SELECT b.full_date, year, month, month_name, b.unit_id, unit_name, status_code, status_label, status_category,
       is_failure, reading_count, CASE WHEN is_failure THEN reading_count ELSE 0 END AS failure_reading_count,
       pct_of_day_readings,
       CASE WHEN status_category = 'OK' THEN round(performance_ratio, 4) END AS avg_performance_ratio,
       had_failure AS had_failure_today
       FROM {breakdown} b LEFT JOIN {performance} p ON p.unit_id = b.unit_id AND p.full_date = b.full_date""",
)


def export(spark, sf_dir):
    rows, units, statuses = base.device(spark, sf_dir)
    days = base.days_of_events(spark, sf_dir)
    return marts.flat_export(
        marts.status_breakdown(rows, days, units, statuses), marts.unit_performance(rows, days, units)
    )


query("flat_export", "SELECT * FROM {export}")(export)


@query(
    "device_fact",
    """SELECT date_key, time_key, unit_id, status_code, ac_power_w, day_energy_kwh, is_failure,
       date_key // 10000 AS year, date_key // 100 % 100 AS month FROM {device}""",
)
def device_fact(spark, sf_dir):
    rows, units, statuses = base.device.build(spark, sf_dir)
    return (
        rows.join(units.select("unit_key", "unit_id"), "unit_key")
        .join(statuses.select("status_key", "status_code"), "status_key")
        .select(
            "date_key", "time_key", "unit_id", "status_code", "ac_power_w", "day_energy_kwh", "is_failure", "year", "month"
        )
    )


@query(
    "meter_fact",
    """SELECT date_key, time_key, cumulative_kwh, delta_kwh, CAST(round(delta_kwh * 0.15, 4) AS DOUBLE) AS cost,
       date_key // 10000 AS year, date_key // 100 % 100 AS month FROM {consumption}""",
)
def meter_fact(spark, sf_dir):
    return base.consumption.build(spark, sf_dir)


@query(
    "environment_fact",
    """SELECT date_key, time_key, temperature_c, CAST(NULL AS DOUBLE) AS temp_variation_c, humidity_pct,
       CAST(NULL AS DOUBLE) AS humidity_variation_pct,
       date_key // 10000 AS year, date_key // 100 % 100 AS month FROM {environment}""",
)
def environment_fact(spark, sf_dir):
    return base.environment.build(spark, sf_dir)


@query(
    "forecast_fact",
    """SELECT date_key, time_key, site_name, measure_code, horizon, round(forecast_value, 6) AS forecast_value
       FROM {forecast_fact}""",
)
def forecast_fact(spark, sf_dir):
    rows, sites, measures = forecast_parts.build(spark, sf_dir)
    return (
        rows.join(sites.select("site_key", "site_name"), "site_key")
        .join(measures.select("measure_key", "measure_code"), "measure_key")
        .select("date_key", "time_key", "site_name", "measure_code", "horizon", F.round("forecast_value", 6).alias("forecast_value"))
    )


@query(
    "booking_fact",
    """SELECT date_key, start_time_key, end_time_key, duration_minutes, room_code, division_name, reservation_no,
       is_recurring, CAST(recurrence_start AS VARCHAR) AS recurrence_start,
       CAST(recurrence_end AS VARCHAR) AS recurrence_end, remark,
       date_key // 10000 AS year, date_key // 100 % 100 AS month FROM {booking_fact}""",
)
def booking_fact(spark, sf_dir):
    rows, rooms, divisions = base.booking_fact.build(spark, sf_dir)
    return (
        rows.join(rooms.select("room_key", "room_code"), "room_key")
        .join(divisions.select("division_key", "division_name"), "division_key")
        .drop("room_key", "division_key")
    )


