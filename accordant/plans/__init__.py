"""How plans are run: shipping this package to Python workers."""
