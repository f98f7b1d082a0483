"""Table schemas. Ids are strings throughout: a leading zero is part of the id."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TRANSACTIONS = _struct(
    t_dat=T.DateType(),
    customer_id=T.StringType(),
    article_id=T.StringType(),
    price=T.DoubleType(),
    sales_channel_id=T.IntegerType(),
)

CUSTOMERS = _struct(
    customer_id=T.StringType(),
    club_member_status=T.StringType(),
    fashion_news_frequency=T.StringType(),
    age=T.IntegerType(),
)

# The catalogue columns that the profiling jobs count, in catalogue order.
ARTICLE_NAME_COLUMNS = (
    "prod_name",
    "product_type_name",
    "product_group_name",
    "graphical_appearance_name",
    "colour_group_name",
    "perceived_colour_value_name",
    "perceived_colour_master_name",
    "department_name",
    "index_name",
    "index_group_name",
    "section_name",
    "garment_group_name",
)

ARTICLES = _struct(
    article_id=T.StringType(),
    product_code=T.IntegerType(),
    **{name: T.StringType() for name in ARTICLE_NAME_COLUMNS},
    detail_desc=T.StringType(),
)

POPULATION = _struct(customer_id=T.StringType(), prediction=T.StringType())
PREDICTIONS = POPULATION
PAIRS = _struct(article_id=T.StringType(), article_id2=T.StringType())
