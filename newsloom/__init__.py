"""News analytics on Spark: landed articles to cleaned, scored, served tables."""
