from vitalgrid.streaming.scoring import REPORTS, file_stream, read_all_rows, read_scored, score_available, score_stream, write_reports

__all__ = ["REPORTS", "file_stream", "read_all_rows", "read_scored", "score_available", "score_stream", "write_reports"]
