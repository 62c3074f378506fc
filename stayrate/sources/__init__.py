"""Raw table readers, mart writers and the adapter for the star-schema test tables."""
