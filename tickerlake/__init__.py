"""tickerlake: market-data and portfolio analytics as lazy Spark DataFrame functions.

Every public function takes DataFrames (and plain Python parameters) and
returns a DataFrame; nothing is collected unless a caller asks for it.
"""

__version__ = "0.1.0"
