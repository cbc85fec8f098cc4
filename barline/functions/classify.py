"""Classifications as column expressions: sector, industry, size, source priority."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Sector of a two-digit SIC prefix.
SECTOR_OF_SIC = {
    "01": "Agriculture", "02": "Agriculture", "07": "Agriculture", "08": "Agriculture", "09": "Agriculture",
    "10": "Mining", "11": "Mining", "12": "Energy", "13": "Energy", "14": "Mining",
    "15": "Construction", "16": "Construction", "17": "Construction",
    "20": "Food & Beverage", "21": "Food & Beverage", "22": "Manufacturing", "23": "Manufacturing",
    "24": "Manufacturing", "25": "Manufacturing", "26": "Manufacturing", "27": "Media & Publishing",
    "28": "Chemicals & Pharmaceuticals", "29": "Energy", "30": "Manufacturing", "31": "Manufacturing",
    "32": "Manufacturing", "33": "Manufacturing", "34": "Manufacturing", "35": "Industrial Machinery",
    "36": "Electronics & Technology", "37": "Transportation Equipment", "38": "Industrial Machinery",
    "39": "Manufacturing",
    "40": "Transportation", "41": "Transportation", "42": "Transportation", "43": "Transportation",
    "44": "Transportation", "45": "Transportation", "46": "Transportation", "47": "Transportation",
    "48": "Communications", "49": "Utilities",
    "50": "Wholesale Trade", "51": "Wholesale Trade",
    "52": "Retail", "53": "Retail", "54": "Retail", "55": "Retail", "56": "Retail", "57": "Retail",
    "58": "Retail", "59": "Retail",
    "60": "Financial Services", "61": "Financial Services", "62": "Financial Services",
    "63": "Financial Services", "64": "Financial Services", "65": "Real Estate", "67": "Financial Services",
    "70": "Hospitality & Leisure", "72": "Services", "73": "Business Services", "75": "Services",
    "76": "Services", "78": "Media & Entertainment", "79": "Hospitality & Leisure", "80": "Healthcare",
    "81": "Services", "82": "Education", "83": "Services", "84": "Services", "86": "Services",
    "87": "Business Services", "88": "Services", "89": "Services",
    "91": "Government", "92": "Government", "93": "Government", "94": "Government", "95": "Government",
    "96": "Government", "97": "Government",
    "99": "Conglomerates",
}
# Security types that are financial instruments when no SIC prefix says otherwise.
FINANCIAL_TYPES = ("ETF", "ETN", "ETV", "FUND", "UNIT", "SP", "WARRANT", "RIGHT", "PFD", "ADRC", "ADRP", "ADRW", "ADRT", "OS")
# What a security type is called where a company has no SIC description.
INDUSTRY_OF_TYPE = {
    "ETF": "Exchange Traded Fund", "ETN": "Exchange Traded Note", "ETV": "Exchange Traded Vehicle",
    "ADRC": "American Depositary Receipt", "ADRP": "American Depositary Receipt",
    "ADRW": "American Depositary Receipt", "ADRT": "American Depositary Receipt",
    "UNIT": "Unit Investment Trust", "RIGHT": "Rights", "PFD": "Preferred Stock", "FUND": "Closed-End Fund",
    "SP": "Structured Product", "WARRANT": "Warrant", "OS": "Ordinary Shares",
}
# Capital above which a company is in a tier, in dollars.
CAP_TIERS = (("Mega Cap", 200e9), ("Large Cap", 10e9), ("Mid Cap", 2e9), ("Small Cap", 300e6), ("Micro Cap", 50e6))
#: Which source wins where several tell of one bar.
PRIORITY = {"flatfile": 2, "stream": 1}


def lookup(table: Mapping[str, str], key: Column) -> Column:
    """table's value for key, null without one: one map literal instead of a chain of comparisons."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def sector(sic: Column, kind: Column, table: Mapping[str, str] = SECTOR_OF_SIC) -> Column:
    by_type = F.when(kind.isin(*FINANCIAL_TYPES), "Financial Services").otherwise("Other")
    return F.coalesce(lookup(table, F.substring(sic, 1, 2)), by_type)


def industry(description: Column, kind: Column) -> Column:
    return F.coalesce(description, lookup(INDUSTRY_OF_TYPE, kind))


def cap_tier(market_cap: Column) -> Column:
    """Tier by strict lower bounds; unknown for null, the smallest tier below all bounds."""
    out = F.lit("Nano Cap")
    for name, above in reversed(CAP_TIERS):
        out = F.when(market_cap > above, name).otherwise(out)
    return F.when(market_cap.isNull(), "Unknown").otherwise(out)


def source_priority(source: Column, table: Mapping[str, int] = PRIORITY) -> Column:
    out = F.lit(0)
    for name, priority in table.items():
        out = F.when(source == name, priority).otherwise(out)
    return out


def compact_number(x: Column, prefix: str = "") -> Column:
    """1234567 as 1.23M: two decimals for billions and millions, none below; null as 0."""
    size = F.abs(x)

    def form(y: Column, digits: int, unit: str) -> Column:
        return F.concat(F.when(x < 0, "-").otherwise(""), F.lit(prefix), F.format_string(f"%.{digits}f{unit}", y.cast("double")))

    return (
        F.when(x.isNull(), F.lit(prefix + "0"))
        .when(size >= 1e9, form(size / 1e9, 2, "B"))
        .when(size >= 1e6, form(size / 1e6, 2, "M"))
        .when(size >= 1e3, form(size / 1e3, 0, "K"))
        .otherwise(form(size, 0, ""))
    )
