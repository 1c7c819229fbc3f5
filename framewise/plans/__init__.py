"""Named queries over the driver tables, each paired with an independent SQL answer."""
