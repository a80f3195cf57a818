"""Land-cover and elevation analytics on geographic grids, as DataFrame transformations."""
