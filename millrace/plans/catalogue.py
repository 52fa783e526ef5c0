"""Article catalogues."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import has_text, map_code, map_unit, strip_zeros
from millrace.operators.columns import upper_all
from millrace.operators.joins import except_by_key, texts_by_language
from millrace.operators.sets import union_all
from millrace.operators.snapshots import latest_by_key

# Language codes of the text table and what each one carries.
TEXT_LANGUAGES = {"S": "text", "Z": "fiscal_code", "Y": "waybill_code"}
# Sales channels and planning types of the sales catalogue.
CHANNELS = ["MI", "ME", "MO"]
PLANNING_TYPES = ["V1", "X0", "Z1"]


def latest_stripped(df: DataFrame, keys: Sequence[str], loaded: Sequence[str], min_zeros: int = 2) -> DataFrame:
    """Newest version per key, the material without its leading zeros."""
    return latest_by_key(df.withColumn("material", strip_zeros("material", min_zeros)), list(keys), list(loaded))


def material_texts(texts: DataFrame, loaded: Sequence[str], languages: Mapping[str, str] = TEXT_LANGUAGES) -> DataFrame:
    """Short text, fiscal code and waybill code of each material, in one pass over the text table."""
    wanted = texts.filter(F.col("language").isin(*languages))
    newest = latest_stripped(wanted, ["material", "language"], loaded)
    return texts_by_language(newest, ["material"], "language", "text", languages)


def service_rows(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Services bought (with their own id) and materials bought, each distinct.

    ``orders``: material, plant, material_group, purchase_type. A missing or blank material is a service.
    """
    stripped = strip_zeros("material")
    no_material = stripped.isNull() | ~has_text(stripped)
    is_service = (stripped.isNotNull() & ~has_text(stripped)) | (F.col("purchase_type") == "SERVICE")
    bought = orders.select(
        F.when(no_material, "SERVICE").otherwise(stripped).alias("material"), "plant", "material_group",
        F.when(is_service, "SERVICE").otherwise(F.col("purchase_type")).alias("purchase_type"),
    )
    services = bought.filter((F.col("material") == "SERVICE") | (F.col("purchase_type") == "SERVICE"))
    named = services.withColumn("material_id", F.concat("material", F.lit("-"), "material_group"))
    materials = bought.filter(F.col("purchase_type") == "MATERIAL").select("material", "plant")
    return named.distinct(), materials.distinct()


def _listed_keys(material: DataFrame, plant: DataFrame) -> DataFrame:
    """Material and plant of every catalogue row. Versions share their key, so no version has to be chosen for this."""
    master = material.select(strip_zeros("material", 2).alias("material"))
    keys = plant.select(strip_zeros("material", 2).alias("material"), "plant").join(master, "material", "left_semi")
    return keys.select(strip_zeros(F.upper("material")).alias("material"), F.upper("plant").alias("plant"))


def article_catalogue(
    material: DataFrame,
    plant: DataFrame,
    valuation: DataFrame,
    texts: DataFrame,
    planners: DataFrame,
    groups: DataFrame,
    sales_lines: DataFrame,
    orders: DataFrame,
    categories: DataFrame,
    *,
    main_plant: str,
    company_by_plant: Mapping[str, str],
    default_company: str,
    loaded: Sequence[str] = ("loaded_at",),
) -> DataFrame:
    """Article catalogue over all plants, with the services and materials that were bought without a master record.

    ``material``: material, material_type, unit, material_group. ``plant``: material, plant, planner_code,
    buying_group, abc. ``valuation``: material, standard_price, variable_price. ``texts``: material, language, text.
    All four carry the load columns. ``planners``: planner_code, plant, planner. ``groups``: material_group,
    group_name. ``sales_lines``: material, system, line. ``orders``: see ``service_rows``. ``categories``: material,
    plant, category.

    The line of the sales catalogue applies to the main plant only. The category comes from the sheet; the main plant
    falls back to the system.
    """
    base = (
        latest_stripped(material, ["material"], loaded)
        .select("material", "material_type", "unit", "material_group")
        .join(latest_stripped(plant, ["material", "plant"], loaded).select("material", "plant", "planner_code", "buying_group", "abc"), "material", "left")
        .join(latest_stripped(valuation, ["material"], loaded).select("material", "standard_price", "variable_price"), "material", "left")
        .join(material_texts(texts, loaded), "material", "left")
        .withColumns(
            {
                "unit": map_unit("unit"),
                "standard_price": F.format_number(F.col("standard_price").cast("double"), 2),
                "variable_price": F.format_number(F.col("variable_price").cast("double"), 2),
            }
        )
    )
    named = (
        upper_all(base)
        .join(planners.withColumn("planner", F.upper("planner")), ["planner_code", "plant"], "left")
        .join(groups.withColumn("group_name", F.upper("group_name")), "material_group", "left")
        .withColumn("material", strip_zeros("material"))
    )
    # The main plant's lines carry their plant, so one join serves all rows instead of a split and a union.
    lines = sales_lines.groupBy("material", "system").agg(F.max("line").alias("line")).withColumn("plant", F.lit(main_plant))
    services, materials = service_rows(orders)
    listed = named.join(lines, ["material", "plant"], "left")
    present = _listed_keys(material, plant).unionByName(services.select("material", "plant"))
    missing = except_by_key(materials, present, ["material", "plant"])
    full = union_all(listed, services, missing)
    sheet = categories.groupBy("material", "plant").agg(F.max("category").alias("category"))
    is_service = F.col("purchase_type") == "SERVICE"
    return (
        full.withColumns(
            {
                "company": map_code("plant", company_by_plant, default_company),
                "purchase_type": F.coalesce("purchase_type", F.lit("MATERIAL")),
                "material_id": F.coalesce("material_id", "material"),
            }
        )
        .withColumns(
            {
                "system": F.when(is_service, "SERVICE").otherwise(F.col("system")),
                "line": F.when(is_service, "SERVICE").otherwise(F.col("line")),
            }
        )
        .join(sheet, ["material", "plant"], "left")
        .withColumn(
            "category",
            F.upper(F.coalesce("category", F.when(F.col("plant") == main_plant, F.col("system")))),
        )
        .distinct()
    )


def sales_catalogue(
    sales_org: DataFrame,
    material: DataFrame,
    plant: DataFrame,
    valuation: DataFrame,
    warehouse: DataFrame,
    texts: DataFrame,
    dictionaries: Sequence[tuple[DataFrame, str]],
    products: DataFrame,
    *,
    loaded: Sequence[str] = ("loaded_at",),
    channels: Sequence[str] = CHANNELS,
    planning_types: Sequence[str] = PLANNING_TYPES,
) -> DataFrame:
    """Sales catalogue, one row per material and sales channel, all text in capitals and numbers as formatted text.

    ``sales_org``: material, channel, the id columns of the dictionaries, status. ``material``: material, unit,
    gross_weight, net_weight, volume, volume_unit, length, width, height. ``plant``: material, planning_type.
    ``valuation``: material, standard_price, variable_price. ``warehouse``: material, storage_type. Each carries the
    load columns; plant, valuation and warehouse hold one plant's rows. ``texts`` as for ``material_texts``.
    ``dictionaries`` pairs a table with the id column it names. ``products``: material and its tariff code.

    Only planned materials stay, so the plant rows are filtered first and joined inner; the newest version counts, then
    its planning type.
    """
    planned = latest_stripped(plant, ["material"], loaded).filter(F.col("planning_type").isin(*planning_types))
    sold = latest_stripped(sales_org.filter(F.col("channel").isin(*channels)), ["material", "channel"], loaded)
    drop = list(loaded)
    out = sold.drop(*drop).join(planned.drop(*drop), "material")
    for part in (material, valuation, warehouse):
        out = out.join(latest_stripped(part, ["material"], loaded).drop(*drop), "material", "left")
    out = out.join(material_texts(texts, loaded), "material", "left")
    for names, key in dictionaries:
        out = out.join(upper_all(names.filter(F.col(key).isNotNull())), key, "left")
    two = {c: F.format_number(F.col(c).try_cast("double"), 2) for c in ("standard_price", "variable_price")}
    three = {
        c: F.format_number(F.col(c).try_cast("double"), 3)
        for c in ("gross_weight", "net_weight", "volume", "length", "width", "height")
    }
    units = {"unit": map_unit("unit"), "volume_unit": map_unit("volume_unit", {"CCM": "CM3"})}
    return upper_all(out.join(products, "material", "left").withColumns({**two, **three, **units}))
