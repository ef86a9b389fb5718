"""Column names and types of the invoice table."""

from pyspark.sql import types as T

# Header names of the invoice file, and our names for them.
SOURCE_NAMES = {
    "N° da fatura": "invoice_no",
    "ID Cliente": "customer_id",
    "Data da fatura": "invoice_ts",
    "País": "country",
    "Quantidade": "quantity",
    "Valor": "amount_txt",
}

RAW_TYPES = {
    "invoice_no": T.StringType(),
    "customer_id": T.LongType(),
    "country": T.StringType(),
    "quantity": T.LongType(),
    "amount_txt": T.StringType(),
}

# Fixed value: the company's home country.
HOME_COUNTRY = "United Kingdom"

# Field texts that mean "missing" in the invoice and lookup files.
MISSING_TEXTS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Money is summed as a decimal, so that no total depends on the order in which
# partitions arrive; reports show doubles.
AMOUNT_SCALE = 2


def amount_type(scale: int = AMOUNT_SCALE) -> T.DecimalType:
    """Sixteen digits before the point, whatever the scale, as far as decimals go."""
    return T.DecimalType(min(38, 16 + scale), scale)
