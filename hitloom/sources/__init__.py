"""Reading feeds, lookups and naming tables; writing layers and exports."""
