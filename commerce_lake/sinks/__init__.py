"""Writers: files, versioned tables, warehouse publishing."""
