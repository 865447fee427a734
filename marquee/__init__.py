"""marquee: catalogue analytics for film and series platforms on Spark.

Reads catalogues from any number of platforms into one table, cleans
descriptions into significant words, ranks description words, genres and
title words per segment (platform x type), scores every title against its
segment's lists and release-year bands, scales the total into a 60-95
success percentage, keeps the best titles and evaluates new candidate titles
against the catalogue, all as native DataFrame plans.
"""

__version__ = "0.1.0"
