"""tastemill: top-n and ranking data engine written as Spark DataFrame plans."""
