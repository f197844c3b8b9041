"""DuckDB SQL that states what the registered queries have to return."""
