"""DataFrame operators: joins, marts, previews, audit, dashboard views and series."""
