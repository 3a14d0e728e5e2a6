"""Classification of the graph service's responses (R-1).

OK: ``received`` is an integer.  NOK: ``message`` is a list whose elements
are all objects (an empty list included).  Anything else, text that is not
JSON included, is UNKNOWN.  Only OK counts as delivered.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OK = "OK"
NOK = "NOK"
UNKNOWN = "UNKNOWN"


def response_status(body: Column) -> Column:
    v = F.try_parse_json(body)
    received = F.try_variant_get(v, "$.received", "variant")
    message = F.try_variant_get(v, "$.message", "array<variant>")
    is_int = ((F.schema_of_variant(received).isin("BIGINT", "INT", "SMALLINT", "TINYINT"))
              & F.try_variant_get(v, "$.received", "int").isNotNull())
    all_objects = F.forall(message, lambda x: F.schema_of_variant(x).startswith("OBJECT"))
    return (F.when(F.coalesce(is_int, F.lit(False)), F.lit(OK))
             .when(F.coalesce(all_objects, F.lit(False)), F.lit(NOK))
             .otherwise(F.lit(UNKNOWN)))
