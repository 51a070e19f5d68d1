"""The entities: file columns, clean columns with types and rules, keys and tracked columns."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# State name -> code.
STATE_CODES = {
    "Delhi": "DL",
    "Maharashtra": "MH",
    "Uttar Pradesh": "UP",
    "Gujarat": "GJ",
    "Rajasthan": "RJ",
    "Kerala": "KL",
    "Punjab": "PB",
    "Karnataka": "KA",
    "Madhya Pradesh": "MP",
    "Odisha": "OR",
    "Chandigarh": "CH",
    "West Bengal": "WB",
    "Sikkim": "SK",
    "Andhra Pradesh": "AP",
    "Assam": "AS",
    "Jammu and Kashmir": "JK",
    "Puducherry": "PY",
    "Uttarakhand": "UK",
    "Himachal Pradesh": "HP",
    "Tamil Nadu": "TN",
    "Goa": "GA",
    "Telangana": "TG",
    "Chhattisgarh": "CG",
    "Jharkhand": "JH",
    "Bihar": "BR",
    "Tripura": "TR",
    "Manipur": "MN",
}

# States that are union territories.
UNION_TERRITORIES = ["Delhi", "Chandigarh", "Puducherry", "Jammu and Kashmir"]

# Cities of the first tier. Both groups map to Tier-1 and no city to Tier-2; pass
# another mapping to ``clean`` to change that.
LARGE_CITIES = ["Mumbai", "Delhi", "Bengaluru", "Hyderabad", "Chennai", "Noida", "Kolkata", "Pune", "Ahmedabad"]
OTHER_CITIES = [
    "Jaipur", "Lucknow", "Kanpur", "Nagpur", "Varanasi", "Indore", "Bhopal", "Patna", "Vadodara", "Coimbatore",
    "Ludhiana", "Agra", "Nashik", "Ranchi", "Meerut", "Allahganj", "Moradabad", "Bareilly", "Aligarh", "Raipur",
    "Ghazipur", "Guwahati", "Chandigarh",
]
CITY_TIERS = {city: "Tier-1" for city in LARGE_CITIES + OTHER_CITIES}
DEFAULT_TIER = "Tier-3"

# What a masked column shows, by tag.
MASKS = {"PII": "**PII**", "EMAIL": "** EMAIL**", "SENSITIVE": "**Phone**"}

AUDIT = ["_stg_file_name", "_stg_file_load_ts", "_stg_file_md5", "_copy_data_ts"]

PREFERENCES_JSON = "FoodPreference string, CuisineTypes array<string>"


@dataclass(frozen=True)
class Col:
    """A clean column. ``source`` is the file header (lower case) it is read from, None if derived."""

    name: str
    source: str | None
    kind: str = "string"
    required: bool = False
    max_len: int | None = None
    tag: str | None = None
    keep_if_null: bool = False


@dataclass(frozen=True)
class Entity:
    name: str
    headers: list[str]
    cols: list[Col]
    keys: list[str]
    bucket_by: list[str]
    dimension: bool = True
    references: Mapping[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [c.name for c in self.cols]

    @property
    def tracked(self) -> list[str]:
        return [c.name for c in self.cols if c.name not in self.keys]

    @property
    def keep_if_null(self) -> list[str]:
        return [c.name for c in self.cols if c.keep_if_null]

    @property
    def tags(self) -> dict[str, str]:
        return {c.name: c.tag for c in self.cols if c.tag}


def _words(text: str) -> list[str]:
    return text.split()


LOCATION = Entity(
    "location",
    _words("locationid city state zipcode activeflag createddate modifieddate"),
    [
        Col("location_id", "locationid", "bigint", required=True),
        Col("city", "city", required=True, max_len=100),
        Col("state", None, required=True, max_len=100),
        Col("state_code", None, required=True, max_len=2),
        Col("is_union_territory", None, "boolean"),
        Col("capital_city_flag", None, "boolean"),
        Col("city_tier", None),
        Col("zip_code", "zipcode", required=True, max_len=10),
        Col("active_flag", "activeflag", required=True, max_len=10),
        Col("created_ts", "createddate", "timestamp", required=True),
        Col("modified_ts", "modifieddate", "timestamp"),
    ],
    keys=["location_id"],
    bucket_by=["location_id"],
)

RESTAURANT = Entity(
    "restaurant",
    _words(
        "restaurantid name cuisinetype pricing_for_2 restaurant_phone operatinghours locationid activeflag"
        " openstatus locality restaurant_address latitude longitude createddate modifieddate"
    ),
    [
        Col("restaurant_id", "restaurantid", "bigint", required=True),
        Col("name", "name", required=True, max_len=100),
        Col("cuisine_type", "cuisinetype"),
        Col("pricing_for_two", "pricing_for_2", "decimal(10,2)"),
        Col("restaurant_phone", "restaurant_phone", max_len=15, tag="SENSITIVE"),
        Col("operating_hours", "operatinghours"),
        Col("location_id_fk", "locationid", "bigint"),
        Col("active_flag", "activeflag"),
        Col("open_status", "openstatus"),
        Col("locality", "locality"),
        Col("restaurant_address", "restaurant_address"),
        Col("latitude", "latitude", "decimal(9,6)"),
        Col("longitude", "longitude", "decimal(9,6)"),
        Col("created_dt", "createddate", "timestamp"),
        Col("modified_dt", "modifieddate", "timestamp"),
    ],
    keys=["restaurant_id"],
    bucket_by=["restaurant_id"],
    references={"location_id_fk": "location"},
)

CUSTOMER = Entity(
    "customer",
    _words("customerid name mobile email loginbyusing gender dob anniversary preferences createddate modifieddate"),
    [
        # A number, so that it joins to the orders and addresses, which carry it as a number.
        Col("customer_id", "customerid", "bigint", required=True),
        Col("first_name", None, required=True, max_len=100),
        Col("last_name", None, required=True, max_len=100),
        Col("mobile", "mobile", tag="PII"),
        Col("email", "email", tag="EMAIL"),
        Col("login_by_using", "loginbyusing"),
        Col("gender", "gender", tag="PII"),
        Col("dob", "dob", "date", tag="PII", keep_if_null=True),
        Col("anniversary", "anniversary", "date", keep_if_null=True),
        Col("preferences", None),
        Col("cuisine_types", None),
        Col("created_dt", "createddate", "timestamp"),
        Col("modified_dt", "modifieddate", "timestamp"),
    ],
    keys=["customer_id"],
    bucket_by=["customer_id"],
)

CUSTOMER_ADDRESS = Entity(
    "customer_address",
    _words(
        "addressid customerid flatno houseno floor building landmark locality city state pincode coordinates"
        " primaryflag addresstype createddate modifieddate"
    ),
    [
        Col("address_id", "addressid", "bigint", required=True),
        Col("customer_id_fk", "customerid", "bigint"),
        Col("flat_no", "flatno"),
        Col("house_no", "houseno"),
        Col("floor", "floor"),
        Col("building", "building"),
        Col("landmark", "landmark"),
        Col("locality", "locality"),
        Col("city", "city"),
        Col("state", "state"),
        Col("pincode", "pincode"),
        Col("coordinates", "coordinates"),
        Col("primary_flag", "primaryflag"),
        Col("address_type", "addresstype"),
        Col("created_date", "createddate", "timestamp"),
        Col("modified_date", "modifieddate", "timestamp"),
    ],
    keys=["address_id"],
    bucket_by=["address_id"],
    references={"customer_id_fk": "customer"},
)

MENU = Entity(
    "menu",
    _words("menuid restaurantid itemname description price category availability itemtype createddate modifieddate"),
    [
        Col("menu_id", "menuid", "bigint", required=True),
        Col("restaurant_id_fk", "restaurantid", "bigint"),
        Col("item_name", "itemname", "text", required=True),
        Col("description", "description", "text", required=True),
        Col("price", "price", "decimal(10,2)", required=True),
        Col("category", "category", "text"),
        Col("availability", "availability", "boolean"),
        Col("item_type", "itemtype", "text"),
        Col("created_dt", "createddate", "timestamp"),
        Col("modified_dt", "modifieddate", "timestamp"),
    ],
    keys=["menu_id"],
    bucket_by=["menu_id"],
    references={"restaurant_id_fk": "restaurant"},
)

DELIVERY_AGENT = Entity(
    "delivery_agent",
    _words("deliveryagentid name phone vehicletype locationid status gender rating createddate modifieddate"),
    [
        Col("delivery_agent_id", "deliveryagentid", "bigint", required=True),
        Col("name", "name", required=True),
        Col("phone", "phone", required=True),
        Col("vehicle_type", "vehicletype", required=True),
        Col("location_id_fk", "locationid", "bigint"),
        Col("status", "status"),
        Col("gender", "gender"),
        Col("rating", "rating", "decimal(4,2)"),
        Col("created_dt", "createddate", "timestamp"),
        Col("modified_dt", "modifieddate", "timestamp"),
    ],
    keys=["delivery_agent_id"],
    bucket_by=["delivery_agent_id"],
    references={"location_id_fk": "location"},
)

ORDERS = Entity(
    "orders",
    _words("orderid customerid restaurantid orderdate totalamount status paymentmethod createddate modifieddate"),
    [
        Col("order_id", "orderid", "bigint", required=True),
        Col("customer_id_fk", "customerid", "bigint"),
        Col("restaurant_id_fk", "restaurantid", "bigint"),
        Col("order_date", "orderdate", "timestamp"),
        Col("total_amount", "totalamount", "decimal(10,2)"),
        Col("status", "status"),
        Col("payment_method", "paymentmethod"),
        Col("created_dt", "createddate", "timestamp"),
        Col("modified_dt", "modifieddate", "timestamp"),
    ],
    keys=["order_id"],
    bucket_by=["order_id"],
    dimension=False,
    references={"customer_id_fk": "customer", "restaurant_id_fk": "restaurant"},
)

ORDER_ITEM = Entity(
    "order_item",
    _words("orderitemid orderid menuid quantity price subtotal createddate modifieddate"),
    [
        Col("order_item_id", "orderitemid", "bigint", required=True),
        Col("order_id_fk", "orderid", "bigint", required=True),
        Col("menu_id_fk", "menuid", "bigint", required=True),
        Col("quantity", "quantity", "decimal(10,2)"),
        Col("price", "price", "decimal(10,2)"),
        Col("subtotal", "subtotal", "decimal(10,2)"),
        Col("created_dt", "createddate", "timestamp"),
        Col("modified_dt", "modifieddate", "timestamp"),
    ],
    keys=["order_item_id", "order_id_fk", "menu_id_fk"],
    bucket_by=["order_id_fk"],
    dimension=False,
    references={"order_id_fk": "orders", "menu_id_fk": "menu"},
)

DELIVERY = Entity(
    "delivery",
    _words(
        "deliveryid orderid deliveryagentid deliverystatus estimatedtime addressid deliverydate"
        " createddate modifieddate"
    ),
    [
        Col("delivery_id", "deliveryid", "bigint", required=True),
        Col("order_id_fk", "orderid", "bigint", required=True),
        Col("delivery_agent_id_fk", "deliveryagentid", "bigint", required=True),
        Col("delivery_status", "deliverystatus"),
        Col("estimated_time", "estimatedtime"),
        Col("customer_address_id_fk", "addressid", "bigint", required=True),
        Col("delivery_date", "deliverydate", "timestamp"),
        Col("created_date", "createddate", "timestamp"),
        Col("modified_date", "modifieddate", "timestamp"),
    ],
    keys=["delivery_id", "order_id_fk", "delivery_agent_id_fk"],
    bucket_by=["order_id_fk"],
    dimension=False,
    references={
        "order_id_fk": "orders",
        "delivery_agent_id_fk": "delivery_agent",
        "customer_address_id_fk": "customer_address",
    },
)

# In loading order: what is referred to comes first.
ENTITIES = {
    e.name: e
    for e in [LOCATION, RESTAURANT, CUSTOMER, CUSTOMER_ADDRESS, MENU, DELIVERY_AGENT, ORDERS, ORDER_ITEM, DELIVERY]
}
DIMENSIONS = [e.name for e in ENTITIES.values() if e.dimension]
