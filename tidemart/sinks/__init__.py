"""Writers: table creation, appends, partition overwrites and JDBC."""
