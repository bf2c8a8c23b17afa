"""The registered queries: feeds derived from the driver's tables, and their SQL."""
