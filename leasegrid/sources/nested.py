"""Nested sources: embedded JSON, HTML tables, GeoJSON, cell grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leasegrid.functions.dates import readable_stamp
from leasegrid.functions.geo import ring_text
from leasegrid.functions.text import blank_to_null

LISTING = (
    "struct<id:string,listingModel:struct<url:string,price:string,"
    "features:struct<beds:string,baths:string,parking:string,propertyTypeFormatted:string,landSize:string>,"
    "address:struct<suburb:string,postcode:string>>>"
)
LISTING_MAP = f"map<string,{LISTING}>"
NEXT_DATA = (
    f"struct<props:struct<pageProps:struct<componentProps:struct<listingsMap:{LISTING_MAP}>,listingsMap:{LISTING_MAP}>,"
    f"listingsMap:{LISTING_MAP}>,listingsMap:{LISTING_MAP}>"
)
DETAIL = """struct<
  propertyType:string, address:string, unitNumber:string, streetNumber:string, street:string,
  stateAbbreviation:string, id:bigint, listingUrl:string, agents:array<struct<name:string>>, agencyName:string,
  description:array<string>, features:array<string>,
  structuredFeatures:array<struct<name:string,category:string,source:string>>,
  listingSummary:struct<title:string,status:string,tag:string>,
  map:struct<latitude:double,longitude:double>,
  suburbInsights:struct<medianRentPrice:int,medianPrice:int,avgDaysOnMarket:int,renterPercentage:double,singlePercentage:double>,
  neighbourhoodInsights:struct<age0To19:double,age20To39:double,age40To59:double,age60Plus:double,longTermResident:double,owner:double,renter:double,family:double,single:double>,
  domainSays:struct<firstListedDate:string,lastSoldOnDate:string,updatedDate:string,numberSold:int>,
  gallery:struct<images:array<string>>,
  inspection:struct<inspectionText:string,appointmentOnly:boolean>,
  schoolCatchment:struct<schools:array<struct<name:string,type:string,educationLevel:string,distance:double>>>>"""
DETAIL = " ".join(DETAIL.split())


def next_data(html: Column) -> Column:
    """Text of the page's __NEXT_DATA__ script; NULL when absent."""
    return blank_to_null(F.regexp_extract(html, r'(?s)<script[^>]*\bid="__NEXT_DATA__"[^>]*>(.*?)</script>', 1))


def listings_from_pages(
    pages: DataFrame, html: str = "html", timestamp: str = "timestamp", suburb: str = "suburb", postcode: str = "postcode", site: str = "", archive: str = "https://web.archive.org/web/"
) -> DataFrame:
    """One row per listing in each archived search page of ``site``.

    The listing map is taken from the first of four known places that is not
    empty. Suburb and postcode fall back to the page's own.
    """
    parsed = pages.withColumn("__j", F.from_json(next_data(F.col(html)), NEXT_DATA))
    places = [
        "__j.props.pageProps.componentProps.listingsMap",
        "__j.props.pageProps.listingsMap",
        "__j.props.listingsMap",
        "__j.listingsMap",
    ]
    found = F.coalesce(*[F.when(F.size(F.col(p)) > 0, F.col(p)) for p in places])
    rows = parsed.select(
        F.col(timestamp).alias("wayback_time"),
        F.col(suburb).alias("__suburb"),
        F.col(postcode).alias("__postcode"),
        F.explode(F.map_values(found)).alias("l"),
    )
    m, f = "l.listingModel", "l.listingModel.features"

    def text(path: str) -> Column:
        return F.coalesce(F.col(path), F.lit(""))

    land = text(f"{f}.landSize")
    features = F.concat(
        text(f"{f}.beds"), F.lit(", ,"), text(f"{f}.baths"), F.lit(", ,"), text(f"{f}.parking"), F.lit(","),
        F.when(~land.isin("", "0"), F.concat(F.lit(" "), land, F.lit(","))).otherwise(""),
    )
    url, stamp = text(f"{m}.url"), F.col("wayback_time")
    archived = F.concat(F.lit(archive), stamp, F.lit(f"/{site}"), url)
    return rows.select(
        F.col("l.id").try_cast("long").alias("property_id"),
        url.alias("url"),
        text(f"{m}.price").alias("rental_price"),
        F.col(f"{f}.beds").try_cast("int").alias("bedrooms"),
        F.col(f"{f}.baths").try_cast("int").alias("bathrooms"),
        F.col(f"{f}.parking").try_cast("int").alias("car_spaces"),
        text(f"{f}.propertyTypeFormatted").alias("property_type"),
        F.col(f"{f}.landSize").try_cast("int").alias("land_area"),
        features.alias("property_features"),
        F.coalesce(f"{m}.address.suburb", "__suburb").alias("suburb"),
        F.coalesce(f"{m}.address.postcode", "__postcode").alias("postcode"),
        F.coalesce(readable_stamp(stamp), stamp).alias("scraped_date"),
        F.when((stamp != "") & (url != ""), archived).otherwise("").alias("wayback_url"),
        F.coalesce(stamp, F.lit("")).alias("wayback_time"),
    )


def listing_details(pages: DataFrame, html: str = "html", keep: Sequence[str] = ()) -> DataFrame:
    """One row per listing page with its nested details projected to columns."""
    schema = f"struct<props:struct<pageProps:struct<componentProps:{DETAIL}>>>"
    c = "__c"
    parsed = pages.withColumn(c, F.from_json(next_data(F.col(html)), schema)["props"]["pageProps"]["componentProps"])
    schools = F.filter(
        F.col(f"{c}.schoolCatchment.schools"),
        lambda s: (F.coalesce(s["name"], F.lit("")) != "")
        & (F.coalesce(s["type"], F.lit("")) != "")
        & (F.coalesce(s["educationLevel"], F.lit("")) != ""),
    )
    schools = F.transform(
        schools,
        lambda s: F.struct(s["name"].alias("name"), s["type"].alias("type"), s["educationLevel"].alias("level"), F.coalesce(s["distance"], F.lit(0.0)).alias("distance")),
    )
    paths = {
        "property_type": "propertyType", "full_address": "address", "unit_number": "unitNumber",
        "street_number": "streetNumber", "street": "street", "state_abbreviation": "stateAbbreviation",
        "property_id": "id", "listing_url": "listingUrl", "agency_name": "agencyName", "features_list": "features",
        "structured_features": "structuredFeatures", "rental_price": "listingSummary.title",
        "listing_status": "listingSummary.status", "listing_tag": "listingSummary.tag",
        "latitude": "map.latitude", "longitude": "map.longitude",
        "median_rent_price": "suburbInsights.medianRentPrice", "median_sold_price": "suburbInsights.medianPrice",
        "avg_days_on_market": "suburbInsights.avgDaysOnMarket",
        "age_0_to_19": "neighbourhoodInsights.age0To19", "age_20_to_39": "neighbourhoodInsights.age20To39",
        "age_40_to_59": "neighbourhoodInsights.age40To59", "age_60_plus": "neighbourhoodInsights.age60Plus",
        "long_term_resident": "neighbourhoodInsights.longTermResident", "owner_percentage": "neighbourhoodInsights.owner",
        "family_percentage": "neighbourhoodInsights.family",
        "first_listed_date": "domainSays.firstListedDate", "last_sold_date": "domainSays.lastSoldOnDate",
        "updated_date": "domainSays.updatedDate", "number_sold": "domainSays.numberSold",
        "image_urls": "gallery.images", "inspection_text": "inspection.inspectionText",
        "appointment_only": "inspection.appointmentOnly",
    }
    return parsed.where(F.col(c).isNotNull()).select(
        *keep,
        *[F.col(f"{c}.{p}").alias(n) for n, p in paths.items()],
        F.coalesce(F.get(F.col(f"{c}.agents"), F.lit(0))["name"], F.lit("")).alias("agent_name"),
        F.trim(F.array_join(f"{c}.description", " ")).alias("description"),
        # The neighbourhood figure overrides the suburb one when present.
        F.coalesce(f"{c}.neighbourhoodInsights.renter", f"{c}.suburbInsights.renterPercentage").alias("renter_percentage"),
        F.coalesce(f"{c}.neighbourhoodInsights.single", f"{c}.suburbInsights.singlePercentage").alias("single_percentage"),
        F.coalesce(F.size(f"{c}.gallery.images"), F.lit(0)).alias("number_of_photos"),
        schools.alias("schools"),
    )


# --- HTML -------------------------------------------------------------------------------


def _cell_text(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"(?s)<[^>]*>", ""), "&nbsp;", " "))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column through a generator, so that later filters read it instead of computing it again."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def html_table(pages: DataFrame, value_columns: Sequence[int] | None, html: str = "html", keep: Sequence[str] = ()) -> DataFrame:
    """(keep, date_text, headers, values) per body row of each page's first table.

    Rows with a blank date are skipped; a blank chosen cell is NULL; a row with
    a non-numeric chosen cell is dropped. ``value_columns=None`` takes every
    column after the first. Each pattern runs once per page or row.
    """
    table = F.regexp_extract(html, r"(?is)<table\b[^>]*>(.*?)</table>", 1)
    rows = F.regexp_extract_all(table, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    opened = _once(pages.select(*keep, html), "__rows", rows).drop(html).where(F.size("__rows") > 1)
    heads = F.regexp_extract_all(F.get("__rows", F.lit(0)), F.lit(r"(?is)<t[hd]\b[^>]*>(.*?)</t[hd]>"), F.lit(1))
    body = _once(opened, "headers", F.transform(heads, _cell_text)).select(
        *keep, "headers", F.explode(F.slice("__rows", 2, F.size("__rows") - 1)).alias("__row")
    )
    cells = F.regexp_extract_all("__row", F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), F.lit(1))
    body = _once(body, "__c", F.transform(cells, _cell_text)).drop("__row")
    date_text = F.get("__c", F.lit(0))
    body = body.where(F.coalesce(date_text, F.lit("")) != "")
    if value_columns is None:
        texts = F.transform(
            F.sequence(F.lit(1), F.greatest(F.size("headers") - 1, F.lit(1))), lambda i: F.get(F.col("__c"), i)
        )
    else:
        texts = F.array(*[F.get("__c", F.lit(i)) for i in value_columns])
    body = _once(body, "__t", F.transform(texts, blank_to_null))
    numeric = F.forall("__t", lambda t: t.isNull() | t.try_cast("double").isNotNull())
    values = F.transform("__t", lambda t: t.try_cast("double"))
    return body.where(numeric).select(*keep, date_text.alias("date_text"), "headers", values.alias("values"))


# --- GeoJSON and grids ------------------------------------------------------------------


def read_geojson_points(spark: SparkSession, path: str, properties: str = "STOP_ID string, STOP_NAME string, MODE string") -> DataFrame:
    """Point features as rows with lat/lon columns."""
    fields = properties.replace(", ", ",").replace(" ", ":")
    schema = f"features array<struct<properties:struct<{fields}>,geometry:struct<type:string,coordinates:array<double>>>>"
    doc = spark.read.schema(schema).json(path, multiLine=True)
    rows = doc.select(F.explode("features").alias("f"))
    return rows.select("f.properties.*", F.get("f.geometry.coordinates", F.lit(1)).alias("lat"), F.get("f.geometry.coordinates", F.lit(0)).alias("lon"))


def flatten_isochrones(responses: DataFrame, listings: DataFrame, batch: str = "batch", ordinal: str = "ordinal", json: str = "json") -> DataFrame:
    """(property_id, coordinates, 5min, 10min, 15min) from isochrone FeatureCollections.

    Three consecutive features belong to one listing of the batch; ``listings``
    carries (batch, ordinal, property_id, coordinates). Empty rings become ''.
    """
    schema = "struct<features:array<struct<properties:struct<value:double>,geometry:struct<coordinates:array<array<array<double>>>>>>>"
    rows = responses.select(batch, F.posexplode(F.from_json(json, schema)["features"]).alias("pos", "f"))
    place = F.floor(F.col("pos") / 3).cast("long").alias(ordinal)
    minutes = F.floor(F.coalesce("f.properties.value", F.lit(0.0)) / 60).cast("int")
    ring = F.get("f.geometry.coordinates", F.lit(0))
    long = rows.select(batch, place, minutes.alias("minutes"), ring_text(ring).alias("wkt"), "pos")
    # A repeated band keeps its last feature.
    wide = long.groupBy(batch, ordinal).pivot("minutes", [5, 10, 15]).agg(F.max_by("wkt", "pos"))
    wide = wide.select(batch, ordinal, *[F.coalesce(F.col(f"`{m}`"), F.lit("")).alias(f"{m}min") for m in (5, 10, 15)])
    return wide.join(listings, [batch, ordinal], "left")


def failed_isochrones(listings: DataFrame) -> DataFrame:
    """Rows of a failed call: every band empty."""
    return listings.withColumns({f"{m}min": F.lit("") for m in (5, 10, 15)})


def flatten_pois(responses: DataFrame, key: str = "property_id", json: str = "json") -> DataFrame:
    """(key, name, amenity, lat, lon): node position, else way/relation centre."""
    schema = (
        "struct<elements:array<struct<lat:double,lon:double,center:struct<lat:double,lon:double>,"
        "tags:struct<name:string,amenity:string>>>>"
    )
    rows = responses.select(key, F.explode(F.from_json(json, schema)["elements"]).alias("e"))
    return rows.select(
        key,
        F.coalesce("e.tags.name", F.lit("Unnamed")).alias("name"),
        F.col("e.tags.amenity").alias("amenity"),
        F.coalesce("e.lat", "e.center.lat").alias("lat"),
        F.coalesce("e.lon", "e.center.lon").alias("lon"),
    )


def cells_from_rows(df: DataFrame, file: Column, sheet: Column, row: Column, values: Sequence[str]) -> DataFrame:
    """Cell grid (file, sheet, row, col, value) of positional sheet rows; empty cells are absent."""
    cells = F.array(*[F.col(f"`{c}`").cast("string") for c in values])
    out = df.select(file.alias("file"), sheet.alias("sheet"), row.cast("int").alias("row"), F.posexplode(cells).alias("col", "value"))
    return out.where(blank_to_null(F.col("value")).isNotNull())
