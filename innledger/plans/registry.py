"""Every query by name, over a folder of sample tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innledger.operators import anomaly, dq, gold, scd, silver
from innledger.operators.dedup import dedup_latest
from innledger.plans import audits, dashboard, feeds, kpi, reports
from innledger.plans.warehouse import Warehouse, warehouse
from innledger.session import new_folder
from innledger.sources import synthetic

Query = Callable[[Warehouse], DataFrame]

# Slicer setting of the sample query.
SLICE_HOTEL, SLICE_CHANNELS, SLICE_TIERS = "H002", ("1-URGENT", "2-HIGH"), ("Gold", "Platinum")


def _row_rule(table: str, name: str) -> Query:
    def run(w: Warehouse) -> DataFrame:
        rules = [r for r in dq.ROW_RULES[table]() if r.name == name]
        return dq.run_rules(w.raw(table), rules)

    return run


def _orphans(table: str, key: str, ref: str, parent: str, parent_name: str) -> Query:
    def run(w: Warehouse) -> DataFrame:
        current = w.table(parent).where("is_current")
        return dq.run_orphans(w.raw(table), current, key, ref, table.upper(), parent_name)

    return run


def _billing_relation(name: str) -> Query:
    def run(w: Warehouse) -> DataFrame:
        joined = dq.bills_with_bookings(w.raw("raw_billing"), w.table("silver_reservations"))
        return dq.run_rules(joined, [r for r in dq.billing_relation_rules() if r.name == name])

    return run


def _current(w: Warehouse, name: str) -> DataFrame:
    return w.table(name).where("is_current")


def _dash(report: Callable[..., DataFrame], *tables: str) -> Query:
    def run(w: Warehouse) -> DataFrame:
        return report(*[_current(w, t) if t.startswith("dim_") else w.table(t) for t in tables])

    return run


def _report(report: Callable[..., DataFrame], *tables: str) -> Query:
    return lambda w: report(*[w.table(t) for t in tables])


def _positions_summary(w: Warehouse) -> DataFrame:
    """Numbering of every keyed table: dense means the highest key equals the number of rows."""
    tables = {
        "dim_guest": "guest_sk",
        "dim_room": "room_sk",
        "fact_reservation": "reservation_sk",
        "fact_housekeeping": "housekeeping_sk",
        "fact_billing": "billing_sk",
    }
    parts = [
        w.table(name).agg(
            F.count("*").alias("total_rows"),
            F.min(key).alias("lowest"),
            F.max(key).alias("highest"),
            F.count_distinct(key).alias("distinct_keys"),
        ).select(F.lit(name).alias("table_name"), "*")
        for name, key in tables.items()
    ]
    return dq.union_all(parts)


def _key_uniqueness(w: Warehouse) -> DataFrame:
    bronze = {table: (w.raw(table), key) for table, (key, _) in dq.VALIDITY.items()}
    loaded = {
        "dim_guest": (w.table("dim_guest"), "guest_sk"),
        "dim_room": (w.table("dim_room"), "room_sk"),
        "fact_reservation": (w.table("fact_reservation"), "reservation_id"),
        "fact_housekeeping": (w.table("fact_housekeeping"), "task_id"),
        "fact_billing": (w.table("fact_billing"), "bill_id"),
    }
    return dq.key_uniqueness({**bronze, **loaded})


def _merge_summaries(w: Warehouse) -> DataFrame:
    guests = scd.merge_summary(w.table("guest_versions"), "VAL_GUESTS")
    return guests.unionByName(scd.merge_summary(w.table("room_versions"), "VAL_ROOMS"))


def _full_log(w: Warehouse) -> DataFrame:
    return w.table("dq_log").unionByName(dq.value_checks(w.raws()))


def _rebuilt_log(w: Warehouse) -> DataFrame:
    table = new_folder(w.spark, "dq-log")
    log = w.table("dq_log")
    dq.write_log(log, table)
    dq.replace_value_entries(dq.value_checks(w.raws()), table)
    return w.spark.read.schema(log.schema).parquet(table).select(*log.columns)


def _measured(report: Callable[[dict[str, DataFrame]], DataFrame], *tables: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: report({name: w.audit(name) for name in tables})


def _value_counts(w: Warehouse) -> DataFrame:
    return dashboard.value_counts(
        [
            (_current(w, "dim_guest"), {"tier": "loyalty_tier"}),
            (_current(w, "dim_room"), {"room_type": "room_type", "room_status": "status"}),
            (w.table("fact_reservation"), {"channel": "booking_channel", "reservation_status": "status"}),
        ]
    )


def _flag(flagged: DataFrame, key: str, flag: str) -> DataFrame:
    return flagged.select(key, flag)


def _synthetic(generate: Callable[..., DataFrame], table: str, key: str) -> Query:
    """Rows made up for every key of a raw table."""
    return lambda w: generate(w.raw(table).select(key), key)


QUERIES: dict[str, Query] = {
    # Sources
    "ingest_csv_nulls": feeds.ingest_csv_nulls,
    "ingest_try_cast": feeds.ingest_try_cast,
    "ingest_reject_rows": feeds.ingest_reject_rows,
    "ingest_reject_log": feeds.ingest_reject_log,
    "bronze_append_reload": feeds.bronze_append_reload,
    "bronze_stream_reload": feeds.bronze_stream_reload,
    "bronze_stream_loads": feeds.bronze_stream_loads,
    "inc_file_filter": feeds.increment_guests,
    "synthetic_guests": _synthetic(synthetic.synthetic_guests, "raw_guests", "guest_id"),
    "synthetic_rooms": _synthetic(synthetic.synthetic_rooms, "raw_rooms", "room_id"),
    "synthetic_reservations": _synthetic(
        synthetic.synthetic_reservations, "raw_reservations", "reservation_id"
    ),
    "synthetic_housekeeping": _synthetic(synthetic.synthetic_housekeeping, "raw_housekeeping", "task_id"),
    "synthetic_billing": _synthetic(synthetic.synthetic_billing, "raw_reservations", "reservation_id"),
    # Validated layer
    "dedup_latest_bill": lambda w: dedup_latest(w.raw("raw_billing"), ["bill_id"], silver.BILL_TIES),
    "silver_guests": Warehouse.silver_guests,
    "silver_rooms": Warehouse.silver_rooms,
    "silver_reservations": Warehouse.silver_reservations,
    "silver_housekeeping": Warehouse.silver_housekeeping,
    "silver_billing": Warehouse.silver_billing,
    "billing_net_amount": _report(silver.billing_net_amount, "silver_billing"),
    # Change tracking
    "scd2_guests_merge": Warehouse.merged_guests,
    "scd2_rooms_merge": Warehouse.merged_rooms,
    "scd2_stream_merge": feeds.stream_merge_rooms,
    "scd2_rooms_merge_in_place": feeds.merge_rooms_in_place,
    "scd2_guests_merge_in_place": feeds.merge_guests_in_place,
    "scd2_merge_summary": _merge_summaries,
    "scd2_guest_history": lambda w: scd.changed_history(w.table("guest_versions").drop("action"), "guest_id"),
    "scd2_room_history": lambda w: scd.changed_history(w.table("room_versions").drop("action"), "room_id"),
    "scd2_audit": lambda w: dq.scd2_audit(
        {"VAL_GUESTS": w.table("guest_versions"), "VAL_ROOMS": w.table("room_versions")}
    ),
    "current_guests": _report(reports.current_guests, "guest_versions"),
    "current_rooms": _report(reports.current_rooms, "room_versions"),
    "guest_versions": _report(reports.guest_versions, "guest_versions"),
    # Data quality
    "dq_guest_tier_profile": lambda w: dq.guest_tier_profile(w.raw("raw_guests")),
    "dq_guest_missing": _row_rule("raw_guests", "dq_guest_missing"),
    "dq_room_values": _row_rule("raw_rooms", "dq_room_values"),
    "dq_room_status": _row_rule("raw_rooms", "dq_room_status"),
    "dq_res_dates": _row_rule("raw_reservations", "dq_res_dates"),
    "dq_res_cancel_late": _row_rule("raw_reservations", "dq_res_cancel_late"),
    "dq_res_orphan_guest": _orphans(
        "raw_reservations", "reservation_id", "guest_id", "guest_versions", "VAL_GUESTS"
    ),
    "dq_res_orphan_room": _orphans(
        "raw_reservations", "reservation_id", "room_id", "room_versions", "VAL_ROOMS"
    ),
    "dq_res_status": _row_rule("raw_reservations", "dq_res_status"),
    "dq_hk_times": _row_rule("raw_housekeeping", "dq_hk_times"),
    "dq_hk_orphan_room": _orphans("raw_housekeeping", "task_id", "room_id", "room_versions", "VAL_ROOMS"),
    "dq_hk_task_type": _row_rule("raw_housekeeping", "dq_hk_task_type"),
    "dq_billing_negative": _row_rule("raw_billing", "dq_billing_negative"),
    "dq_billing_orphan_res": _billing_relation("dq_billing_orphan_res"),
    "dq_billing_payment_before_booking": _billing_relation("dq_billing_payment_before_booking"),
    "vc_total_amount": _row_rule("raw_billing", "vc_total_amount"),
    "vc_taxes": _row_rule("raw_billing", "vc_taxes"),
    "vc_discounts": _row_rule("raw_billing", "vc_discounts"),
    "vc_capacity": _row_rule("raw_rooms", "vc_capacity"),
    "vc_res_status": _row_rule("raw_reservations", "vc_res_status"),
    "vc_room_status": _row_rule("raw_rooms", "vc_room_status"),
    "vc_hk_status": _row_rule("raw_housekeeping", "vc_hk_status"),
    "dq_log_full": _full_log,
    "dq_log_rebuild": lambda w: dq.rebuild_log(w.table("dq_log"), dq.value_checks(w.raws())),
    "dq_log_rebuild_in_place": _rebuilt_log,
    "dq_log_summary": lambda w: dq.log_summary(_full_log(w)),
    "dq_log_by_table": _report(dq.log_by_table, "dq_log"),
    "dq_unexplained_drops": lambda w: dq.unexplained_drops(w.raws()),
    "dq_key_uniqueness": _key_uniqueness,
    "ri_checks": _report(
        dq.integrity_checks,
        "guest_versions",
        "room_versions",
        "silver_reservations",
        "silver_housekeeping",
        "silver_billing",
    ),
    "temporal_checks": _report(
        dq.temporal_checks, "silver_reservations", "silver_housekeeping", "silver_billing"
    ),
    "silver_row_counts": _report(
        dq.silver_row_counts,
        "guest_versions",
        "room_versions",
        "silver_reservations",
        "silver_housekeeping",
        "silver_billing",
        "dq_log",
    ),
    # Star schema
    "surrogate_keys": _positions_summary,
    "dim_guest_load": Warehouse.dim_guest,
    "dim_room_load": Warehouse.dim_room,
    "fact_reservation_load": lambda w: w.reservation_load()
    .select(*gold.FACT_RESERVATION)
    .drop("reservation_sk"),
    "fact_housekeeping_load": lambda w: w.housekeeping_load()
    .select(*gold.FACT_HOUSEKEEPING)
    .drop("housekeeping_sk"),
    "fact_billing_load": lambda w: w.billing_load()
    .select(*gold.FACT_BILLING)
    .withColumn("has_reservation", F.col("reservation_sk").isNotNull())
    .drop("billing_sk", "reservation_sk"),
    "gold_reservation_wide": lambda w: w.table("fact_reservation").drop("reservation_sk"),
    "gold_housekeeping_wide": lambda w: w.table("fact_housekeeping").drop("housekeeping_sk"),
    "gold_billing_wide": lambda w: w.table("fact_billing").drop("billing_sk", "reservation_sk"),
    "gold_load_audit": _report(
        gold.load_audit, "dim_guest", "dim_room", "reservation_load", "fact_housekeeping", "fact_billing"
    ),
    # Audits taken while the tables were written
    "audit_row_counts": _measured(
        audits.row_counts,
        "guest_versions",
        "room_versions",
        "silver_reservations",
        "silver_housekeeping",
        "silver_billing",
        "dq_log",
    ),
    "audit_merges": _measured(audits.merge_summary, "guest_versions", "room_versions"),
    "audit_gold_loads": _measured(
        audits.load_audit, "dim_guest", "dim_room", "reservation_load", "fact_housekeeping", "fact_billing"
    ),
    # Anomalies
    "anomaly_double_booking": lambda w: _flag(
        anomaly.flag_double_bookings(w.table("reservation_load")), "reservation_id", "is_double_booked"
    ),
    "anomaly_suspicious_cancel": lambda w: _flag(
        anomaly.flag_suspicious_cancels(
            w.table("reservation_load"), w.clock.cancels_as_of, w.clock.cancels_hours, w.clock.cancels_threshold
        ),
        "reservation_id",
        "is_suspicious_cancel",
    ),
    "anomaly_sla_refresh": lambda w: _flag(
        anomaly.refresh_sla_flags(w.table("fact_housekeeping")), "task_id", "sla_breached"
    ),
    "anomaly_billing_mismatch": lambda w: _flag(
        anomaly.flag_billing_mismatches(w.billing_load(), w.clock.tolerance), "bill_id", "billing_mismatch"
    ),
    "anomaly_summary": _report(
        anomaly.anomaly_summary, "fact_reservation", "fact_housekeeping", "fact_billing"
    ),
    # Indicators
    "kpi1_occupancy": _report(kpi.kpi1_occupancy, "fact_reservation", "dim_room"),
    "kpi1_occupancy_nightly": _report(kpi.kpi1_occupancy_nightly, "fact_reservation", "dim_room"),
    "kpi1_first_days": _report(kpi.kpi1_first_days, "fact_reservation", "dim_room"),
    "kpi2_conversion": _report(kpi.kpi2_conversion, "fact_reservation"),
    "kpi3_sla": _report(kpi.kpi3_sla, "fact_housekeeping"),
    "kpi4_revpar": _report(kpi.kpi4_revpar, "fact_billing", "fact_reservation", "dim_room"),
    "kpi5_billing_accuracy": _report(kpi.kpi5_billing_accuracy, "fact_billing"),
    # Reports over the validated layer
    "guest_tier_distribution": _report(reports.guest_tier_distribution, "guest_versions"),
    "guests_by_country": _report(reports.guests_by_country, "guest_versions"),
    "room_status_stats": _report(reports.room_status_stats, "room_versions"),
    "rooms_by_hotel": _report(reports.rooms_by_hotel, "room_versions"),
    "reservation_status_stats": _report(reports.reservation_status_stats, "silver_reservations"),
    "bookings_by_channel": _report(reports.bookings_by_channel, "silver_reservations"),
    "cancelled_detail": _report(reports.cancelled_detail, "silver_reservations"),
    "sla_by_task_type": _report(reports.sla_by_task_type, "silver_housekeeping"),
    "issues_by_room": _report(reports.issues_by_room, "silver_housekeeping"),
    "staff_performance": _report(reports.staff_performance, "silver_housekeeping"),
    "housekeeping_listing": _report(reports.housekeeping_listing, "silver_housekeeping"),
    "revenue_by_payment_mode": _report(reports.revenue_by_payment_mode, "silver_billing"),
    "flagged_bills": _report(reports.flagged_bills, "silver_billing"),
    "billing_stats": _report(reports.billing_stats, "silver_billing"),
    # Dashboard
    "dash_slicers": lambda w: dashboard.sliced_rows(
        w.table("fact_reservation"), _current(w, "dim_guest"), SLICE_HOTEL, SLICE_CHANNELS, SLICE_TIERS
    ),
    "dash_header_kpis": _dash(
        dashboard.header_kpis, "fact_reservation", "dim_room", "fact_housekeeping", "fact_billing"
    ),
    "dash_monthly_bookings": _dash(dashboard.monthly_bookings, "fact_reservation"),
    "dash_value_counts": _value_counts,
    "dash_los_distribution": _dash(dashboard.los_distribution, "fact_reservation"),
    "dash_revenue_by_channel": _dash(dashboard.revenue_by_channel, "fact_reservation", "fact_billing"),
    "dash_reservation_listing": _dash(dashboard.reservation_listing, "fact_reservation"),
    "dash_sla_split": _dash(dashboard.sla_split, "fact_housekeeping"),
    "dash_duration_histogram": _dash(dashboard.duration_histogram, "fact_housekeeping"),
    "dash_staff": _dash(dashboard.staff, "fact_housekeeping"),
    "dash_issue_pct_by_hotel": _dash(dashboard.issue_pct_by_hotel, "fact_housekeeping"),
    "dash_revenue_by_mode": _dash(dashboard.revenue_by_mode, "fact_billing"),
    "dash_amount_histogram": _dash(dashboard.amount_histogram, "fact_billing"),
    "dash_flagged": _dash(dashboard.flagged, "fact_billing"),
    "dash_billing_listing": _dash(dashboard.billing_listing, "fact_billing"),
    "dash_anomaly_counts": _dash(
        dashboard.anomaly_counts, "fact_reservation", "fact_housekeeping", "fact_billing"
    ),
    "dash_double_booked": _dash(dashboard.double_booked, "fact_reservation"),
    "dash_suspicious": _dash(dashboard.suspicious, "fact_reservation"),
    "dash_sla_breaches": _dash(dashboard.sla_breaches, "fact_housekeeping"),
    "dash_kpi_summary": _dash(
        dashboard.kpi_summary, "fact_reservation", "dim_room", "fact_housekeeping", "fact_billing"
    ),
}


#: What a run of the pipeline writes out: audits, checks, indicators, reports and dashboard data.
REPORTS = [
    *["scd2_audit", "ri_checks", "temporal_checks", "silver_row_counts", "dq_key_uniqueness", "dq_log_summary"],
    *["anomaly_summary", "current_guests", "current_rooms", "guest_versions"],
    *[name for name in QUERIES if name.startswith("kpi")],
    *list(QUERIES)[list(QUERIES).index("guest_tier_distribution") :],
]


def query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: QUERIES[name](warehouse(spark, sf_dir))
