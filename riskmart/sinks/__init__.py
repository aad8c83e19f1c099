"""Writers for Bronze, Silver and Gold."""
