"""Fixed values of the hotel data model: value lists, thresholds, layouts, hotels."""

from __future__ import annotations

# Accepted values per column.
LOYALTY_TIERS = ("Bronze", "Silver", "Gold", "Platinum")
ROOM_STATUSES = ("Available", "Occupied", "Maintenance")
RESERVATION_STATUSES = ("confirmed", "cancelled", "completed")
TASK_TYPES = ("cleaning", "maintenance")
TASK_STATUSES = ("completed", "pending", "in progress", "pending review")

# Text read as true, after trimming and upper-casing.
TRUE_TEXTS = ("TRUE", "1", "YES", "Y", "T")

# Text read as NULL: by the per-entity loads, and by the shared file format.
LOAD_NULL_TOKENS = ("", "NULL", "null", "N/A")
STAGE_NULL_TOKENS = ("", "NULL", "null", "N/A", "NA", "none", "None")

# Files of an increment carry this marker; in LIKE the underscore matches any one character.
INCREMENT_PATTERN = "%_inc%"

# Service level per task type, in minutes.
SLA_MINUTES = {"cleaning": 45, "maintenance": 120}

# Anomaly detection defaults.
MISMATCH_TOLERANCE = 500
CANCEL_THRESHOLD = 3
CANCEL_WINDOW_HOURS = 24

# Open end of a current version.
OPEN_END_DATE = "9999-12-31"
SCD_COLUMNS = ("scd_start_date", "scd_end_date", "is_current", "scd_version")

# Columns of the change-tracked entities: what opens a new version, what is overwritten in place.
GUEST_TRACKED = ("loyalty_tier",)
GUEST_OVERWRITE = ("name", "email", "phone", "address", "city", "country")
ROOM_TRACKED = ("base_price", "amenities")
ROOM_OVERWRITE = ("status", "floor", "capacity")

# Dashboard targets: a KPI passes above its threshold; gauges show a target and three bands.
PASS_THRESHOLDS = {
    "occupancy": 60,
    "conversion": 70,
    "sla_cleaning": 85,
    "sla_maintenance": 85,
    "revpar": 500,
    "billing_accuracy": 0.90,
}
GAUGES = {  # kpi -> (target, upper edge of the low band, upper edge of the middle band)
    "occupancy": (75, 50, 75),
    "billing_accuracy": (95, 90, 95),
}
CANCEL_WARNING = 5
HISTOGRAM_BINS = 20

# The hotels of the chain with id, name, city, country, stars and rooms.
HOTELS = (
    ("H001", "Mumbai Central", "Mumbai", "India", 5, 120),
    ("H002", "Delhi North", "Delhi", "India", 4, 95),
    ("H003", "Bangalore Tech", "Bangalore", "India", 5, 110),
    ("H004", "Hyderabad Pearl", "Hyderabad", "India", 4, 85),
    ("H005", "Chennai Marina", "Chennai", "India", 3, 70),
)
HOTEL_LAYOUT = (
    "hotel_sk bigint, hotel_id string, hotel_name string, city string, country string, "
    "star_rating int, total_rooms int"
)

# Raw file layouts, in file column order. Money is exact decimal, clocks carry no zone.
RAW_LAYOUTS = {
    "guests": (
        "guest_id string, name string, dob date, gender string, email string, phone string, "
        "address string, city string, country string, loyalty_tier string, registration_date date"
    ),
    "reservations": (
        "reservation_id string, guest_id string, room_id string, check_in_date date, "
        "check_out_date date, booking_channel string, booking_time timestamp_ntz, "
        "cancellation_time timestamp_ntz, status string"
    ),
    "rooms": (
        "room_id string, hotel_id string, room_type string, floor int, capacity int, "
        "amenities string, status string, base_price decimal(18,2)"
    ),
    "housekeeping": (
        "task_id string, room_id string, task_type string, assigned_staff string, "
        "scheduled_time timestamp_ntz, start_time timestamp_ntz, end_time timestamp_ntz, "
        "issue_detected_flag boolean, status string"
    ),
    "billing": (
        "bill_id string, reservation_id string, guest_id string, total_amount decimal(18,2), "
        "taxes decimal(18,2), discounts decimal(18,2), payment_mode string, "
        "payment_time timestamp_ntz, is_flagged boolean"
    ),
}
