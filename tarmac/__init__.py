"""tarmac — a Spark-native bookings lakehouse: typed CSV ingestion (bronze),
one wide table (silver), eight grouped marts (gold) and the analytic views of
the airport dashboard, all as DataFrame plans that run on executors."""

__version__ = "0.1.0"
