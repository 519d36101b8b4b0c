"""Column-level functions; everything here is ``Column -> Column``."""
