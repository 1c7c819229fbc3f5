"""Sources and sinks (S-rows of the inventory)."""
