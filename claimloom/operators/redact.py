"""The redaction gate: what may be published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from claimloom.functions.scalar import scrub_emails

# Bodies whose phone may be published, and the parts of contact fields' names.
PUBLIC_REGISTRY = ["recognized_museum", "public_library"]
PUBLIC_OWNERS = ["state", "council"]
CONTACT_FIELDS = ["phone", "email"]


def _has_text(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_has_text(f.dataType) for f in kind)
    if isinstance(kind, MapType):
        return _has_text(kind.valueType)
    return isinstance(kind, StringType) or isinstance(kind, ArrayType) and _has_text(kind.elementType)


def scrubbed(value: Column, kind: DataType) -> Column:
    """value with mail addresses scrubbed from every text inside it, to any depth; parts without text are left alone."""
    if not _has_text(kind):
        return value
    if isinstance(kind, StringType):
        return scrub_emails(value)
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: scrubbed(x, kind.elementType))
    if isinstance(kind, MapType):
        return F.transform_values(value, lambda _, x: scrubbed(x, kind.valueType))
    return F.when(value.isNotNull(), F.struct(*(scrubbed(value[f.name], f.dataType).alias(f.name) for f in kind)))


def scrub_all(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """rows with every text scrubbed, but for the columns of keep. Applying it twice is applying it once."""
    return rows.select(*(F.col(f"`{f.name}`") if f.name in keep else scrubbed(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in rows.schema))


def redact_sites(sites: DataFrame, registry: str = "reg_institution", owner: str = "ownership") -> DataFrame:
    """sites without mail addresses, and without the phones of bodies that are not public; contact_withheld and removed say what went."""
    public = F.coalesce(F.col(registry).isin(PUBLIC_REGISTRY), F.lit(False)) | F.coalesce(F.col(owner).isin(PUBLIC_OWNERS), F.lit(False))
    gone = {"email": F.coalesce(F.col("email") != "", F.lit(False)), "phone": F.coalesce(F.col("phone") != "", F.lit(False)) & ~public}
    out = sites.withColumn("removed", F.array_compact(F.array(*(F.when(v, k) for k, v in gone.items()))))
    out = out.withColumns({"email": F.when(F.col("email") == "", F.col("email")), "phone": F.when(~F.array_contains("removed", "phone"), F.col("phone"))})
    return scrub_all(out.withColumn("contact_withheld", F.size("removed") > 0), keep=("removed",))


def redact_claims(log: Column) -> Column:
    """A claim log (array of structs with field and value) without contact fields, its values scrubbed."""
    kept = F.filter(log, lambda c: ~c["field"].isin(CONTACT_FIELDS))
    return F.transform(kept, lambda c: c.withField("value", scrub_emails(c["value"])))


def drop_columns(rows: DataFrame, contacts: list[str], persons: Column | None = None) -> DataFrame:
    """rows with contact columns set to null, without those that stand for a person, all other texts scrubbed."""
    kept = rows if persons is None else rows.where(~F.coalesce(persons, F.lit(False)))
    return scrub_all(kept.withColumns({c: F.lit(None).cast(kept.schema[c].dataType) for c in contacts if c in kept.columns}))


def drop_tags(tags: Column) -> Column:
    """A map without the tags whose names hold 'email' or 'phone'."""
    return F.map_filter(tags, lambda k, _: ~F.contains(k, F.lit("email")) & ~F.contains(k, F.lit("phone")))


# Contact columns of all payloads, and those of one source besides.
CONTACT_COLUMNS = ["email", "site_email", "contact:email", "operator:email", "wd_P968_email", "דואר אלקטרוני", "phone", "site_phone", "contact:phone", "operator:phone", "wd_P1329_phone_number", "מספר טלפון"]
HERITAGE_CONTACTS = ["shimur_info_block__טלפון", "shimur_info_block__דוא''ל", "marker_kv_דוא“ל", "marker_kv_טלפון"]
PERSON, KIND = "אדם", "סוג רשומה"


def redact_payload(source: str, rows: DataFrame) -> DataFrame:
    """The gate of every payload that is archived: persons' rows and a licence's holder go by the source's own rule; then, for all sources, contact columns and contact tags, and every mail address in any text."""
    persons = None
    if source == "iicp_culture_table":
        person = F.trim(F.col(f"`{KIND}`")) == PERSON if KIND in rows.columns else F.lit(False)
        persons = person | (F.coalesce(F.col("_excluded"), F.lit(False)) if "_excluded" in rows.columns else F.lit(False))
    if source == "culture_institutions" and "business_licence" in rows.columns:
        names = rows.schema["business_licence"].dataType.names
        licence = F.col("business_licence")
        kept = [licence[n].alias(n) for n in ("licence_type", "valid_until") if n in names]
        rows = rows.withColumn("business_licence", F.when(licence.isNotNull(), F.struct(*kept)) if kept else F.lit(None).cast("string"))
    if "osm_tags" in rows.columns:
        rows = rows.withColumn("osm_tags", drop_tags(F.col("osm_tags")))
    more = HERITAGE_CONTACTS if source == "heritage_official" else []
    return drop_columns(rows, CONTACT_COLUMNS + more, persons)


def leaks(texts: DataFrame, column: str, key: str) -> DataFrame:
    """(key, found): the mail addresses that are left in published texts; rows without any are left out."""
    found = F.array_distinct(F.regexp_extract_all(column, F.lit(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"), F.lit(0)))
    return texts.select(key, found.alias("found")).where(F.size("found") > 0)


def publishable(sites: DataFrame, metres: float = 300.0) -> DataFrame:
    """sites but for those outside by more than the distance; those without a position stay."""
    return sites.where(F.coalesce(F.col("in_council") | (F.col("dist_to_boundary_m") >= -metres), F.lit(True)))
