"""Place-registry data integration as PySpark DataFrame transforms."""
