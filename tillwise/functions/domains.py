"""Fixed values of the shop's data model, and expressions that look them up."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# They must equal the data model's own lists for the checks to mean the same.
COUNTRY_REGION = {
    "France": "Europe-West",
    "Belgium": "Europe-West",
    "Switzerland": "Europe-West",
    "Canada": "North America",
    "Morocco": "Africa-North",
    "Tunisia": "Africa-North",
    "Senegal": "Africa-West",
}
OTHER_REGION = "Other"

CATEGORY_PRICE_BAND = {
    "Electronics": (99.99, 499.99),
    "Audio": (49.99, 299.99),
    "Office Furniture": (79.99, 799.99),
    "Accessories": (9.99, 49.99),
    "Storage": (19.99, 149.99),
}

PAGE_DURATION_BAND = {
    "/home": (10.0, 60.0),
    "/products": (30.0, 300.0),
    "/cart": (20.0, 180.0),
    "/checkout": (60.0, 600.0),
    "/profile": (15.0, 120.0),
    "/support": (30.0, 240.0),
    "/deals": (20.0, 180.0),
    "/category/electronics": (30.0, 300.0),
    "/category/audio": (30.0, 300.0),
}

# Statuses the order stream keeps; any other becomes UNKNOWN_STATUS.
STREAM_STATUSES = ("pending", "confirmed", "shipped", "delivered", "cancelled")
UNKNOWN_STATUS = "unknown"

ACCEPTED = {
    "clients": {
        "gender": ("M", "F", "Non-binary"),
        "country": tuple(COUNTRY_REGION),
        "segment": ("new", "regular"),
    },
    "products": {"category": tuple(CATEGORY_PRICE_BAND)},
    "orders": {
        "status": ("Delivered", "Pending", "Cancelled", "Refunded"),
        "payment_method": ("Credit card", "PayPal", "Bank transfer", "Cheque"),
    },
    "incidents": {
        "category": ("Payment", "Delivery", "Defective product", "Login", "Customer service"),
        "status": ("Resolved", "In progress", "Escalated", "Closed"),
        "priority": ("Low", "Medium", "High", "Critical"),
    },
    "page_views": {
        "page": tuple(PAGE_DURATION_BAND),
        "device": ("Mobile", "Desktop", "Tablet"),
        "browser": ("Chrome", "Safari", "Firefox", "Edge"),
        "traffic_source": ("Direct", "Google", "Instagram", "Email", "Referral"),
    },
}
# End of fixed values.


def lookup(key: Column, table: dict) -> Column:
    """Constant table as an expression: no join, NULL for an unknown or NULL key."""
    if not table:
        return F.lit(None)
    result = None
    for name, value in table.items():
        hit = key == F.lit(name)
        result = F.when(hit, F.lit(value)) if result is None else result.when(hit, F.lit(value))
    return result


def region_of(country: Column, regions: dict[str, str] | None = None) -> Column:
    """Sales region of a country, ``Other`` when the country is unknown."""
    return F.coalesce(lookup(country, COUNTRY_REGION if regions is None else regions),
                      F.lit(OTHER_REGION))


def inside(value: Column, key: Column, bands: dict[str, tuple[float, float]]) -> Column:
    """Whether the value lies in its key's band; NULL when the key has none."""
    low = lookup(key, {k: float(b[0]) for k, b in bands.items()})
    high = lookup(key, {k: float(b[1]) for k, b in bands.items()})
    return value.between(low, high)
