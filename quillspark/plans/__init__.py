"""Query plans over the driver tables: each builder takes (spark, sf_dir)
and returns a lazy DataFrame; ``oracle`` holds the equivalent SQL."""
