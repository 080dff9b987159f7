"""The retail model: raw feeds, cleaned tables, star schema."""
