"""Dictionary pages and requirements to the registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.operators.ranking import row_numbers
from siftspark.operators.reshape import expand_requirements
from siftspark.registry import Registry
from siftspark.sources.dictionary import dictionary_links

# Fixed value: where the page of one dictionary item is, below the site's root.
ITEM_PAGE = "/dictionaries/mmcif_pdbx_v50.dic/Items/_"


def build_registry(pages: DataFrame, requirements: DataFrame, site: str = "") -> DataFrame:
    """Required attributes as rows (category, attribute, ordinal, link).

    `pages` holds (category, html); attributes asked for by name need no page, their link
    follows from their name. Feed the rows to `registry_from_frame`.
    """
    listed = (
        dictionary_links(pages)
        .groupBy("category", "attribute")
        .agg(F.min(F.struct("ordinal", "link")).alias("_first"))
        .select("category", "attribute", "_first.ordinal", "_first.link")
    )
    wanted = expand_requirements(requirements, listed)
    own_page = F.concat(F.lit(ITEM_PAGE), "category", F.lit("."), "attribute", F.lit(".html"))
    rows = wanted.join(
        listed.select("category", "attribute", "link"), ["category", "attribute"], "left"
    ).select(
        "category",
        "attribute",
        F.col("ordinal").alias("_listed"),
        F.concat(F.lit(site), F.coalesce("link", own_page)).alias("link"),
    )
    numbered = row_numbers(rows, ["_listed", "attribute"], ["category"], "ordinal")
    return numbered.select("category", "attribute", "ordinal", "link")


def write_registry(attributes: DataFrame, registry: Registry, path: str) -> None:
    """Both forms as JSON: every attribute with its link, and the empty document."""
    attributes.write.mode("overwrite").json(f"{path}/full_schema_dict")
    carcass = registry.frame(attributes.sparkSession).filter("attribute <> 'experiment'")
    carcass.groupBy("category").agg(
        F.sort_array(F.collect_list(F.struct("ordinal", "attribute"))).getField("attribute").alias(
            "attributes"
        )
    ).write.mode("overwrite").json(f"{path}/schema_carcass")
