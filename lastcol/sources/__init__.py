from lastcol.sources.tagged import (TaggedRead, check_ids, format_records, read_tagged, read_tagged_records,
                                    read_tagged_rejects, records_from, tagged_text,
                                    write_tagged_records)

__all__ = ["TaggedRead", "check_ids", "format_records", "read_tagged", "read_tagged_records",
           "read_tagged_rejects", "records_from", "tagged_text", "write_tagged_records"]
