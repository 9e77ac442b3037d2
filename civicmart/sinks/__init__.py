"""Writers, audit columns, row metrics and catalog definitions."""
