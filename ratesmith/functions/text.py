"""Names, codes, dates and plans as column expressions."""

from __future__ import annotations

from functools import reduce
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ratesmith.rules import tables as T



def _names_map() -> Column:
    """Characters of named references, names as the standard library has them."""
    return F.create_map(*(F.lit(x) for name, text in html5.items() for x in (name, text)))


#: Names that need no semicolon, longer ones first.
_BARE_NAMES = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
#: What numbers from 0x80 to 0x9F stand for: characters of Windows-1252 where it has them.
_CONTROLS = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}


def _of_number(number: Column) -> Column:
    """The character of a code point, as browsers read it: null and out of range is the replacement character."""
    wrong = (number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF)
    plain = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    old = F.create_map(*(F.lit(x) for n, c in _CONTROLS.items() for x in (n, c)))
    return F.when(wrong, "\ufffd").when(number.between(0x80, 0x9F), F.try_element_at(old, number.cast("int"))).otherwise(plain)


def decoded(c: Column) -> Column:
    """Character references decoded, named and numeric ones, with and without their semicolon. A text without `&` costs one look."""

    def one(part: Column) -> Column:
        digits = lambda base: F.regexp_extract(part, r"^#[xX]([0-9a-fA-F]+);?" if base == 16 else r"^#([0-9]+);?", 1)
        short = lambda d: F.substring(F.concat(F.lit("0"), F.regexp_replace(d, "^0+", "")), 1, 9)  # noqa: E731  # longer ones are out of range anyway
        after = lambda pattern: F.regexp_replace(part, pattern, "")
        name, bare = F.regexp_extract(part, r"^([A-Za-z][A-Za-z0-9]*;)", 1), F.regexp_extract(part, f"^({_BARE_NAMES})", 1)
        whole = F.try_element_at(_names_map(), name)
        return (
            F.when(digits(16) != "", F.concat(_of_number(F.conv(short(digits(16)), 16, 10).cast("long")), after(r"^#[xX][0-9a-fA-F]+;?")))
            .when(digits(10) != "", F.concat(_of_number(short(digits(10)).cast("long")), after(r"^#[0-9]+;?")))
            .when((name != "") & whole.isNotNull(), F.concat(whole, F.substring(part, F.length(name) + 1, F.length(part))))
            .when(bare != "", F.concat(F.try_element_at(_names_map(), bare), F.substring(part, F.length(bare) + 1, F.length(part))))
            .otherwise(F.concat(F.lit("&"), part))
        )

    parts = F.split(c, "&")
    return F.when(c.contains("&"), F.concat(F.element_at(parts, 1), F.array_join(F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), one), ""))).otherwise(c)


#: What has Unicode's property White_Space.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def stripped(c: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(stripped(c), F.lit(""))


def folded(c: Column) -> Column:
    return F.lower(stripped(F.coalesce(c, F.lit(""))))


def normalise_name(c: Column) -> Column:
    """Character references decoded, [codes] dropped, separators and white space flattened; null is empty."""
    plain = F.regexp_replace(F.regexp_replace(decoded(F.coalesce(c, F.lit(""))), r"\[[^\]]*\]", " "), r"[_/|,;+&()\[\]-]+", " ")
    return F.trim(F.regexp_replace(plain, r"(?U)\s+", " "))


def first_rule(c: Column, rules: list[tuple[str, str]]) -> Column:
    """The label of the first rule whose pattern stands in c, else null."""
    return F.coalesce(*(F.when(c.rlike(f"(?i){pattern}"), F.lit(label)) for label, pattern in rules))


def classify_product(payer: Column, plan: Column) -> Column:
    return product_of(normalise_name(payer), normalise_name(plan))


def product_of(payer: Column, plan: Column) -> Column:
    """The product of names that are normalised already: make those columns of their own, each stands here many times."""
    bare = (plan == "") | (F.lower(plan) == F.lower(payer))
    return F.coalesce(first_rule(F.concat_ws(" ", payer, plan), T.PRODUCT_RULES), F.when(bare, F.lit("no_plan_detail")), F.lit("unclassified"))


def classify_methodology(c: Column) -> Column:
    return F.coalesce(first_rule(F.coalesce(c, F.lit("")), T.METHODOLOGY_RULES), F.lit("unknown"))


def canonical_key(c: Column) -> Column:
    """A payer's name for look-ups: no codes of 4 to 8 digits and no company words."""
    key = F.regexp_replace(F.lower(normalise_name(c)), T.PAYER_CODES, " ")
    key = F.regexp_replace(key, T.COMPANY_WORDS, " ")
    return F.trim(F.regexp_replace(key, r"\s+", " "))


def parse_date(c: Column) -> Column:
    """The first of the date spellings that fits, else null."""
    return F.coalesce(*(F.try_to_timestamp(stripped(c), F.lit(f)).cast("date") for f in T.DATE_FORMATS))


def partition_vintage(c: Column) -> Column:
    return F.coalesce(F.date_format(parse_date(c), "yyyy-MM"), F.lit("unknown"))


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^a-z0-9]+", "-"), r"^-|-$", "")


def to_decimal(c: Column) -> Column:
    """A number with $ , % or spaces; null if it isn't one."""
    return F.regexp_replace(c, r"[$,%\s]", "").try_cast("decimal(38,10)")


def code_key(c: Column) -> Column:
    return F.upper(stripped(F.coalesce(c, F.lit(""))))


def unpadded(c: Column) -> Column:
    key = code_key(c)
    return F.when(key.rlike(r"^\d+$"), F.regexp_replace(key, r"^0+(?=.)", "")).otherwise(key)


def padded_revenue(c: Column) -> Column:
    """A revenue code in four digits; codes that aren't digits stay."""
    key = code_key(c)
    return F.when(key.rlike(r"^\d{1,3}$"), F.lpad(key, 4, "0")).otherwise(key)


def code_family(c: Column) -> Column:
    key = F.replace(code_key(c), F.lit("_"), F.lit("-"))
    return F.coalesce(*(F.when(key.isin(types), F.lit(family)) for family, types in T.CODE_FAMILIES.items()))


def setting_key(c: Column) -> Column:
    """The bucket of a setting; `both` and blank are the bucket that meets any."""
    key = folded(c)
    return F.when(key == "both", F.lit("")).otherwise(key)


def differs(a: Column, b: Column) -> Column:
    """True only if both are stated and not the same."""
    return (folded(a) != "") & (folded(b) != "") & (folded(a) != folded(b))


def network_tokens(c: Column) -> Column:
    """The network products that a plan names, as a sorted array."""
    text = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", " ")
    text = reduce(lambda x, s: F.replace(x, F.lit(s[0]), F.lit(f" {s[1]} ")), T.PLAN_SYNONYMS, F.lower(text))
    return F.array_sort(F.array_intersect(F.split(text, r"[^a-z]+"), F.array(*map(F.lit, T.PRODUCT_TOKENS))))


def plan_verdict(plan: Column, network: Column) -> Column:
    """match, aggregate (the plan covers several networks), no_match, or unknown (a side names none)."""
    return tokens_verdict(network_tokens(plan), network_tokens(network))


def tokens_verdict(mine: Column, theirs: Column) -> Column:
    """plan_verdict of both sides' tokens."""
    same = F.arrays_overlap(mine, theirs) | ((mine == F.array(F.lit("openaccess"))) & F.array_contains(theirs, "oap"))
    return F.when((F.size(mine) == 0) | (F.size(theirs) == 0), "unknown").when(F.size(mine) > 1, "aggregate").when(same, "match").otherwise("no_match")


def row_hash(*columns: Column) -> Column:
    """32 hex digits over the fields, null as empty."""
    return F.substring(F.sha2(F.concat_ws("␟", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns)), 256), 1, 32)


def row_codes(c: Column) -> Column:
    """[[code, type], ...] in JSON, as an array of arrays."""
    return F.from_json(c, "array<array<string>>")


def split_label(c: Column) -> tuple[Column, Column]:
    """Carrier and network of a file's label, cut at its first _. Labels that begin with T.STATE_LABEL have a state between the two;
    a label without _ is both."""
    head, tail = F.split_part(c, F.lit("_"), F.lit(1)), F.regexp_extract(c, r"^[^_]*_(.*)$", 1)
    product = F.regexp_extract(tail, r"^[^_]*_(.*)$", 1)
    network = F.when((F.upper(head) == T.STATE_LABEL) & (product != ""), product).when(tail != "", tail).otherwise(head)
    return head, network


def place_setting(c: Column) -> Column:
    """inpatient, outpatient or both from place-of-service codes joined by |. No codes and T.ANY_PLACE restrict nothing, which is
    both; null if all codes are of other places, which the hospital side doesn't tell apart."""
    whole = stripped(F.coalesce(c, F.lit("")))
    codes = F.filter(F.transform(F.split(whole, r"\|"), lambda x: stripped(x)), lambda x: x != "")
    inside, outside = (F.arrays_overlap(codes, F.array(*map(F.lit, places))) for places in (T.INPATIENT_PLACES, T.OUTPATIENT_PLACES))
    return F.when((whole == T.ANY_PLACE) | (F.size(codes) == 0) | (inside & outside), "both").when(inside, "inpatient").when(outside, "outpatient")


def expand_range(c: Column) -> Column:
    """360-362 as [0360, 0361, 0362]: codes of four digits, the ends included."""
    low, high = (F.regexp_extract(c, r"^\s*(\d+)\s*(?:-\s*(\d+))?\s*$", i) for i in (1, 2))
    last = F.when(high == "", low).otherwise(high)
    return F.when(low != "", F.transform(F.sequence(low.cast("int"), F.greatest(low.cast("int"), last.cast("int"))), lambda x: F.lpad(x.cast("string"), 4, "0")))


def _repaired(texts: pd.Series) -> pd.Series:
    def one(text: str | None) -> str | None:
        try:
            return text.encode("cp1252").decode() if text else text
        except (UnicodeEncodeError, UnicodeDecodeError):
            return text

    return texts.map(one)


def repair_mojibake(c: Column) -> Column:
    """UTF-8 that was read as Windows-1252, read right; any other text as it is. For distinct names: it leaves the JVM."""
    return F.pandas_udf(_repaired, "string")(c)
