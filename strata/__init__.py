"""strata: a Spark-native medallion (bronze / silver / gold) analytics library.

Raw files are landed by ingestion date (bronze), typed and canonicalised into
silver tables, modelled into a star schema with dense surrogate keys, checked
for primary/foreign-key integrity and summarised into marts (gold), then served
through read-only SQL.  Every step is a DataFrame/SQL job.
"""

__version__ = "0.1.0"
