"""Column lists of the bronze, silver and gold tables."""

CSV_LISTING = (
    "model string, year int, price int, transmission string, mileage int, "
    "fuelType string, tax int, mpg double, engineSize double"
)

API_LISTING = (
    "id string, brand string, title string, price string, year int, mileage int, "
    "fuelType string, engineSize double, transmission string, search_timestamp timestamp"
)

FACT = (
    "brand string, model string, year int, price bigint, transmission string, mileage int, "
    "fuel_type string, tax int, mpg double, engine_size double, "
    "is_ulez_compliant boolean, vehicle_age int, price_per_mile double"
)

CLUSTER_MART = (
    "brand string, model string, year int, price double, mileage double, fuel_type string, "
    "engine_size double, is_ulez_compliant boolean, cluster_id int, cluster_name string"
)

API_ADVERT = {
    "advertId": "string",
    "title": "string",
    "subTitle": "string",
    "attentionGrabber": "string",
    "price": "string",
    "badges": "array<struct<type: string, displayText: string>>",
    "trackingContext": "struct<advertContext: struct<make: string, model: string, year: int, price: string>>",
}


def api_response(advert: dict[str, str]) -> str:
    """The type of a response document whose listings have the fields of ``advert``."""
    fields = ", ".join(f"{name}: {type_name}" for name, type_name in advert.items())
    return f"array<struct<data: struct<searchResults: struct<listings: array<struct<{fields}>>>>>>"


API_REQUEST = "make string, fuel_filter string, page int, status_code int, body string"


def columns_of(ddl: str) -> dict[str, str]:
    """Name to type of a flat DDL column list, in order."""
    return dict(part.strip().split(" ", 1) for part in ddl.split(","))
