"""The corpus operators' queries and the SQL that they are held against."""

from . import langid, mixing, neardup, packing, quality, quotes, repeats, secrets, urls, vectors

_QUERIES = {
    "op1_quality_rules": (quality.op1_quality_rules, quality.OP1_SQL),
    "op5_url_filter": (urls.op5_url_filter, None),
    "op6_source_mix": (mixing.op6_source_mix, mixing.OP6_SQL),
    "op7_secret_scan": (secrets.op7_secret_scan, secrets.OP7_SQL),
    "op2_language_id": (langid.op2_language_id, None),
    "op3_near_vectors": (vectors.op3_near_vectors, None),
    "op4_near_duplicates": (neardup.op4_near_duplicates, None),
    "op8_quote_links": (quotes.op8_quote_links, None),
    "op9_repeated_strings": (repeats.op9_repeated_strings, None),
    "op10_packing": (packing.op10_packing, None),
}


def queries():
    return {name: query for name, (query, _) in _QUERIES.items()}


def oracle_sql():
    return {name: sql for name, (_, sql) in _QUERIES.items() if sql}
