"""Product fields from the metadata a page embeds.

Each function takes columns and returns one candidate struct, or a list of
them. The struct fields are those of `schema.CANDIDATE`.
"""

from collections.abc import Callable

from pyspark.sql import Column, functions as F, types as T

from adgleaner import schema
from adgleaner.functions import text as tx, values, web

_TYPES = {f.name: f.dataType for f in schema.CANDIDATE.fields}


def candidate(origin: str, **found: Column) -> Column:
    """Candidate struct: the fields given, all others NULL."""
    fields = {"origin": F.lit(origin), **found}
    return F.struct(
        *[
            fields.get(n, F.lit(None)).cast(t).alias(n)
            for n, t in _TYPES.items()
        ]
    )


def no_candidates() -> Column:
    return F.array().cast(T.ArrayType(schema.CANDIDATE))


def bound(make: Callable[..., Column], **parts: Column) -> Column:
    """`make` of some parts, each computed once. Within a lambda an expression runs as often as it is written."""
    one = F.array(F.struct(*[c.alias(n) for n, c in parts.items()]))
    return F.get(F.transform(one, lambda x: make(**{n: x[n] for n in parts})), 0)


# --- values of any shape -----------------------------------------------------


def _text(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def _value(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def _is_object(v: Column) -> Column:
    """True for an object that is not empty."""
    return F.coalesce(F.size(F.try_variant_get(v, "$", "map<string,variant>")) > 0, F.lit(False))


def _is_list(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>").isNotNull()


def _as_list(v: Column) -> Column:
    """A list as it is, anything else as a list of one."""
    return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v))


def _texts(v: Column, path: str) -> Column:
    """A list of texts as it is, a text as a list of one; NULL if there is none."""
    one = _text(v, path)
    return F.when(_is_list(_value(v, path)), F.try_variant_get(v, path, "array<string>")).when(
        one.isNotNull(), F.array(one)
    )


def image_address(image: Column, with_url: bool) -> Column:
    """Address in an image that may be a text, an object, or a list of either."""
    first = F.when(_is_list(image), F.try_variant_get(image, "$[0]", "variant")).otherwise(image)

    def address(first: Column) -> Column:
        steps = [F.nullif(_text(first, "$.contentUrl"), F.lit(""))]
        if with_url:
            steps.append(F.nullif(_text(first, "$.url"), F.lit("")))
        return F.coalesce(*steps, _text(first, "$"))

    return bound(address, first=first)


_NUMBER_TYPE = r"^(?:TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)$"


def _price(v: Column) -> Column:
    """A number as it is, else the number in a text."""
    is_number = F.schema_of_variant(v).rlike(_NUMBER_TYPE)
    return F.when(is_number, F.try_variant_get(v, "$", "double")).otherwise(values.price(_text(v, "$")))


def _prices(v: Column, path: str) -> Column:
    """The prices of a list or a single value; NULL if there is none."""
    return F.when(_texts(v, path).isNotNull(), F.transform(_as_list(_value(v, path)), _price))


def _mean(prices: Column) -> Column:
    return values.mean(F.filter(prices, lambda x: x.isNotNull()))


def offer_prices(offer: Column) -> Column:
    """Price of an offer, else its low and high price; NULL if it has neither."""
    low, high = _value(offer, "$.lowPrice"), _value(offer, "$.highPrice")
    some = _text(offer, "$.lowPrice").isNotNull() | _text(offer, "$.highPrice").isNotNull()
    return F.coalesce(_prices(offer, "$.price"), F.when(some, F.array(_price(low), _price(high))))


def _last(items: Column) -> Column:
    return F.try_element_at(items, F.lit(-1))


# --- JSON-LD -----------------------------------------------------------------

# Comments are passed over as wholes. What is not closed runs to the end, so that no part is scanned twice.
_SCRIPT = r"(?is)<!--.*?(?:-->|\z)|<script\b([^>]*+)(?:>|\z)(.*?)(?:</script\s*>|\z)"
# Old pages hide a script from older readers.
_WRAPPER = r"^(?:<!--|(?://\s*)?<!\[CDATA\[)|(?://\s*)?(?:-->|\]\]>)$"


def json_ld_bodies(html: Column) -> Column:
    """The JSON-LD texts of a page; NULL if it has none."""
    parts = [F.regexp_extract_all(html, F.lit(_SCRIPT), F.lit(i)) for i in (1, 2)]
    body = F.zip_with(*parts, lambda kind, b: F.when(kind.rlike(r"(?i)application/ld\+json"), b))
    found = F.when(html.rlike(r"(?i)ld\+json"), F.filter(body, lambda b: b.isNotNull()))
    return F.transform(found, lambda b: tx.strip(F.regexp_replace(tx.strip(b), _WRAPPER, "")))


def _parsed(body: Column) -> Column:
    # Many sites break lines within a text, which strict JSON does not allow.
    return F.coalesce(F.try_parse_json(body), F.try_parse_json(F.regexp_replace(body, r"[\x00-\x1f]", " ")))


def unparsed(bodies: Column) -> Column:
    """The texts, if one of them does not parse; it may repeat a key, which browsers allow."""
    return F.when(F.exists(bodies, lambda b: _parsed(b).isNull()), bodies)


def json_ld_items(bodies: Column) -> Column:
    """All top-level JSON-LD items of a page as variants; a list counts item by item."""
    parsed = F.filter(F.transform(bodies, _parsed), lambda v: v.isNotNull())
    return F.flatten(F.transform(parsed, _as_list))


def json_ld_products(items: Column) -> Column:
    """One candidate per item whose type is exactly `Product`."""
    products = F.filter(items, lambda v: F.coalesce(_text(v, "$['@type']") == "Product", F.lit(False)))
    return F.coalesce(F.transform(products, json_ld_candidate), no_candidates())


def json_ld_candidate(item: Column) -> Column:
    # The last offer wins; seller and location come from the last offer that has them.
    def of_offers(offers: Column) -> Column:
        return bound(
            found,
            offer=_last(offers),
            seller=_value(_last(F.filter(offers, lambda o: _is_object(_value(o, "$.seller")))), "$.seller"),
            address=_value(
                _last(F.filter(offers, lambda o: _is_object(_value(o, "$.seller.address")))), "$.seller.address"
            ),
            image=_value(item, "$.image"),
        )

    def found(offer: Column, seller: Column, address: Column, image: Column) -> Column:
        return candidate(
            "json-ld",
            name=_text(item, "$.name"),
            description=_text(item, "$.description"),
            image=image_address(image, with_url=True),
            production_data=_text(item, "$.productionDate"),
            category=_text(item, "$.category"),
            price=_mean(offer_prices(offer)),
            currency=values.currency(_texts(offer, "$.priceCurrency")),
            seller=_text(seller, "$.name"),
            seller_type=_text(seller, "$['@type']"),
            seller_url=_text(seller, "$.url"),
            location=_text(address, "$.addressCountry"),
        )

    return bound(of_offers, offers=F.filter(_as_list(_value(item, "$.offers")), _is_object))


# --- Microdata ---------------------------------------------------------------


def microdata_products(items: Column) -> Column:
    """One candidate per top-level item, whatever its type; `items` are JSON texts."""
    return F.coalesce(
        F.transform(F.transform(items, F.try_parse_json), microdata_candidate), no_candidates()
    )


def microdata_candidate(item: Column) -> Column:
    """The object read last wins: top-level seller, then offers, then those of the main entity.

    A list of offers counts only without a top-level seller, and then its first
    offer does. An offer that names no price leaves the price found before.
    """
    def of_parts(offers: Column, seller: Column, inner: Column, image: Column) -> Column:
        has_seller = _is_object(seller)
        listed = F.when(_is_list(offers) & ~has_seller, F.try_variant_get(offers, "$[0]", "variant"))
        flags = {"has_seller": has_seller, "has_offer": _is_object(offers), "has_inner": _is_object(inner)}
        return bound(
            lambda **more: _microdata_found(item, offers, seller, inner, image, **more), **flags, listed=listed
        )

    parts = {"offers": "$.offers", "seller": "$.seller", "inner": "$.mainEntity.offers", "image": "$.image"}
    return bound(of_parts, **{n: _value(item, path) for n, path in parts.items()})


def _microdata_found(
    item: Column,
    offers: Column,
    seller: Column,
    inner: Column,
    image: Column,
    has_seller: Column,
    has_offer: Column,
    has_inner: Column,
    listed: Column,
) -> Column:
    def chosen(pick) -> Column:
        """`pick` of the last present offer."""
        return F.when(_is_object(listed), pick(listed)).when(has_offer, pick(offers)).when(has_inner, pick(inner))

    def from_seller(path: str, needs: str) -> Column:
        """Seller value of the last object whose `needs` part is present."""
        case = F.when(
            has_seller if needs == "$.seller" else _is_object(_value(seller, "$.address")),
            _text(seller, path),
        )
        for offer in (listed, offers, inner):
            case = case.when(_is_object(_value(offer, needs)), _text(_value(offer, "$.seller"), path))
        return case

    named = F.coalesce(
        F.when(_is_object(listed), _prices(listed, "$.price")),
        F.when(has_offer, _prices(offers, "$.price")),
        F.when(has_inner, _prices(inner, "$.price")),
        _prices(item, "$.price"),
    )
    return candidate(
        "microdata",
        name=_text(item, "$.name"),
        description=_text(item, "$.description"),
        image=image_address(image, with_url=False),
        production_data=_text(item, "$.productionDate"),
        category=_text(item, "$.category"),
        price=_mean(named),
        currency=values.currency(chosen(lambda o: _texts(o, "$.priceCurrency"))),
        seller=from_seller("$.name", "$.seller"),
        seller_type=from_seller("$['@type']", "$.seller"),
        seller_url=F.when(has_seller, _text(seller, "$.url")),
        location=from_seller("$.address.addressCountry", "$.seller.address"),
    )


# --- Meta elements: OpenGraph and Dublin Core --------------------------------


# Comments, scripts and styles are passed over as wholes; group 2 is what a `<meta>` element holds.
_META = rf"(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*+(?:>|\z).*?(?:</\1\s*>|\z)|<meta(?=[\s/])({web.TAG_REST})(?:>|\z)"
# One attribute: name, then a value quoted either way or bare.
_ATTRIBUTE = r"""([^\s=>"'/][^\s=>/]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?"""
_META_ATTRIBUTES = ("property", "name", "content", "price", "currency", "category")


def _attributes(rest: Column) -> Column:
    """Attributes of an element in order, as (name, value); the name is in lower case."""
    cut = [F.regexp_extract_all(rest, F.lit(_ATTRIBUTE), F.lit(i)) for i in range(1, 5)]
    return F.transform(
        F.arrays_zip(*[c.alias(n) for c, n in zip(cut, ("name", "double", "single", "bare"))]),
        lambda x: F.struct(F.lower(x["name"]).alias("name"), tx.unescape(F.concat(x["double"], x["single"], x["bare"])).alias("value")),
    )


def meta_elements(html: Column) -> Column:
    """`<meta>` elements that name a property, or a Dublin Core description with a price."""
    rests = F.when(html.rlike(r"(?i)<meta[\s/]"), F.regexp_extract_all(html, F.lit(_META), F.lit(2)))
    used = F.filter(rests, lambda t: t.rlike(r"(?i)(?:property|price)\s*="))

    def named(pairs: Column) -> Column:
        def value(name: str) -> Column:
            same = F.filter(pairs, lambda x: x["name"] == name)
            return F.coalesce(F.get(same, 0)["value"], F.lit(""))

        return F.struct(*[value(a).alias(a) for a in _META_ATTRIBUTES])

    found = F.transform(F.transform(used, _attributes), named)
    return F.filter(found, lambda m: (m["property"] != "") | (m["price"] != ""))


def open_graph_products(metas: Column) -> Column:
    """One candidate if the page has any OpenGraph property; of a repeated one the first counts."""

    def prop(name: str) -> Column:
        same = F.filter(metas, lambda m: m["property"] == name)
        return F.get(same, 0)["content"]

    found = candidate(
        "opengraph",
        name=prop("og:title"),
        description=prop("og:description"),
        price=values.price(prop("product:price:amount")),
        currency=prop("product:price:currency"),
        category=prop("product:category"),
        image=prop("og:image"),
        seller_url=prop("og:see_also"),
    )
    present = F.exists(metas, lambda m: m["property"].startswith("og:") | m["property"].startswith("product:"))
    return F.when(present, F.array(found)).otherwise(no_candidates())


def dublin_core_products(metas: Column) -> Column:
    """One candidate from the last `description` element that has a price."""
    priced = F.filter(
        metas,
        lambda m: (F.regexp_replace(m["name"], r"(?i)^dc(?:terms)?\.", "") == "description") & (m["price"] != ""),
    )
    last = _last(priced)
    found = candidate(
        "dublincore",
        name=F.lit("description"),
        description=last["content"],
        price=values.price(last["price"]),
        currency=F.nullif(last["currency"], F.lit("")),
        category=F.nullif(last["category"], F.lit("")),
    )
    return F.when(F.size(priced) > 0, F.array(found)).otherwise(no_candidates())


# --- Blocks of one site ------------------------------------------------------


def site_seller_products(site: Column, seller_block: Column, location_block: Column) -> Column:
    """Seller and location blocks of the auction site; a missing block gives an empty text."""
    last_part = tx.strip(F.substring_index(location_block, ":", -1))
    found = candidate(
        "site seller",
        seller=F.coalesce(seller_block, F.lit("")),
        location=F.coalesce(last_part, F.lit("")),
    )
    return F.when(F.contains(site, F.lit("ebay")), F.array(found)).otherwise(no_candidates())
