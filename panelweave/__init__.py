"""DataFrame operators for panel data that is released again and again."""
