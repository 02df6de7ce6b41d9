"""Landed-data synchronisation on Spark.

Keeps reference tables current from sheet exports, crawled pages, brochure
text, API responses and model replies. Every operator takes and returns a
DataFrame; sources, sinks and streams live beside them.
"""

__version__ = "0.1.0"
