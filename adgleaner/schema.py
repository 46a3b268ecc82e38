"""Table schemas. Every reader and every empty frame uses one of these."""

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# One crawled page as it lies in a crawl file.
RAW_PAGE = T.StructType(
    _strings("url", "content", "content_type") + [T.StructField("fetch_time", T.LongType())]
)

# One search hit; the payload sits under `_source`.
INDEX_PAGE = T.StructType(
    _strings("url", "title", "text", "domain", "retrieved", "html", "content_type")
)
INDEX_HIT = T.StructType([T.StructField("_source", INDEX_PAGE)])

PAGE_FIELDS = ("url", "title", "text", "domain", "retrieved")

# What an extractor can find on a page. `price` is a number by then.
FOUND_FIELDS = (
    "name",
    "description",
    "image",
    "production_data",
    "category",
    "price",
    "currency",
    "seller",
    "seller_type",
    "seller_url",
    "location",
    "ships to",
)


def _found(name: str) -> T.StructField:
    return T.StructField(name, T.DoubleType() if name == "price" else T.StringType())


CANDIDATE = T.StructType(_strings("origin") + [_found(n) for n in FOUND_FIELDS])
LISTING = T.StructType(_strings(*PAGE_FIELDS) + [_found(n) for n in FOUND_FIELDS])
CLASSIFIED = T.StructType(
    LISTING.fields
    + _strings("id", "image_path")
    + [T.StructField("predicted_label", T.IntegerType())]
)

# Image manifest: an image, one id for it, the number of listings that show it, its path.
IMAGES = T.StructType(
    _strings("image", "image_id") + [T.StructField("n_rows", T.LongType())] + _strings("image_path")
)
