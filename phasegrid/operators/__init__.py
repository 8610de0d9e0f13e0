"""DataFrame operators over the long raster form, pixel tubes and scene tables."""
