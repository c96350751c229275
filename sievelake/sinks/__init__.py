"""Writers: message publishing and append streams."""
