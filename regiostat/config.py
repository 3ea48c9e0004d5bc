"""Fixed values that results depend on.

These are the defaults the original pipeline hard-codes; every operator
takes them as parameters, these are only the defaults.
"""

# Projection, vintage, naming, decimal storage type.
DEFAULT_SRID = 3035
NUTS_VINTAGE = "2013-01-01"
STAT_DECIMAL = "decimal(20,2)"
DEFAULT_START = "1970-01-01 00:00:00"
DEFAULT_RESOLUTION = "year"
NAME_TOKEN = ""  # a word to drop from table names; empty: none
MAX_NAME_LENGTH = 50
MAX_TEXT_LENGTH = 255

