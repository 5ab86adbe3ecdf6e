"""A small synthetic code base, for tests and for queries whose operators need source text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestrata.plans.store import Sources
from lodestrata.sources.lines import line_table

COPYBOOKS = {
    "FIXREC": """\
       01 FIX-REC.
          05 FIX-ID PIC 9(11).
          05 FIX-AMT PIC S9(9)V99 COMP-3.
""",
    "FIXNEST": """\
       01 :TAG:-OUTER.
          05 :TAG:-KEY PIC X(08).
           COPY FIXREC.
""",
}
PROGRAMS = {
    "FIXA01C.cbl": """\
      * FIXA01C - SYNTHETIC FIXTURE
       IDENTIFICATION DIVISION.
       PROGRAM-ID. FIXA01C.
       DATA DIVISION.
       WORKING-STORAGE SECTION.
       COPY FIXREC.
       01 WS-FLAG PIC X.
       PROCEDURE DIVISION.
       MAIN-PARA.
           PERFORM 1000-OPEN
           PERFORM 2000-READ UNTIL WS-FLAG = 'Y'
           IF WS-FLAG = 'Y'
               PERFORM 9000-CLOSE
           ELSE
               MOVE 'N' TO WS-FLAG
           END-IF
           CALL 'SUBPGM1' USING WS-FLAG.
       1000-OPEN.
           OPEN INPUT IN-FILE
      *    PERFORM 9999-COMMENTED
           PERFORM 1100-INIT THRU 1100-EXIT.
       2000-READ.
           READ IN-FILE
           EVALUATE WS-FLAG
               WHEN 'A'
                   MOVE WS-IN TO WS-OUT
               WHEN OTHER
                   CALL WS-PGM
           END-EVALUATE.
       9000-CLOSE.
           CLOSE IN-FILE.
           EXEC CICS RETURN
               TRANSID('FX01')
           END-EXEC.
""",
    "COFIX02C.cbl": """\
       IDENTIFICATION DIVISION.
       PROGRAM-ID. COFIX02C.
       ENVIRONMENT DIVISION.
           SELECT ACCT-FILE ASSIGN TO ACCTFIL.
       DATA DIVISION.
       FILE SECTION.
       FD ACCT-FILE
           RECORD CONTAINS 120 CHARACTERS
           RECORD KEY ACCT-ID.
       01 ACCT-REC PIC X(120).
       WORKING-STORAGE SECTION.
           COPY FIXNEST REPLACING
               ==:TAG:== BY ==WS==.
       01 WS-COUNT PIC S9(4) COMP.
       PROCEDURE DIVISION.
       MAIN-PARA.
           PERFORM 3000-LOOP VARYING WS-COUNT FROM 1 BY 1
           EXEC CICS XCTL PROGRAM('FIXA01C')
               COMMAREA(WS-AREA)
           END-EXEC.
       3000-LOOP.
           MOVE WS-KEY TO WS-TMP WS-OUT
           MOVE WS-TMP TO WS-OUT-KEY.
           EXEC DLI GU USING PCB(1)
               SEGMENT(CUSTSEG) WHERE(CUSTKEY = WS-KEY)
           END-EXEC
           CALL 'MQPUT' USING W-HCONN, REPLY-QUEUE-NAME
           CALL 'MQOPEN' USING W-HCONN, MQ-OD.
""",
}
JCL = {
    "JOBA.jcl": """\
//JOBA JOB CLASS=A
//* COMMENT
//STEP1 EXEC PGM=FIXA01C
//STEPLIB DD DSN=FIX.LOADLIB,DISP=SHR
//OUTDD DD DSN=FIX.DATA(+1),
//         DISP=(NEW,CATLG,DELETE)
//SYSPRINT DD SYSOUT=*
""",
    "JOBB.jcl": """\
//JOBB JOB CLASS=A
//STEP1 EXEC PGM=FIXB01C
//INDD DD DSN=FIX.DATA(0),DISP=SHR
//CARDS DD *
//NOTADD DD DSN=IN.STREAM,DISP=SHR
/*
//LIBDD DD DSN=FIX.LOADLIB(MEMBER),DISP=OLD
""",
}
BMS = {
    "FIXMAP.bms": """\
FIXSET  DFHMSD TYPE=MAP,LANG=COBOL
FIXMAP  DFHMDI SIZE=(24,80)
        DFHMDF POS=(1,1),LENGTH=5,ATTRB=(ASKIP,NORM)
ACCT    DFHMDF POS=(2,10),LENGTH=11,ATTRB=(UNPROT,NUM,IC),-
               COLOR=GREEN
        DFHMSD TYPE=FINAL
"""
}
CSD = {
    "FIX.csd": """\
* CATALOGUE
DEFINE FILE(ACCTFIL) GROUP(FIX) DSNAME(FIX.ACCT.KSDS)
       READ(YES) STATUS(ENABLED)
DEFINE FILE(ACCTAIX) GROUP(FIX) DSNAME(FIX.ACCT.KSDS.AIX.PATH)
DEFINE TRANSACTION(FX01) GROUP(FIX) PROGRAM(FIXA01C)
DEFINE TRANSACTION(FX02) GROUP(FIX) PROGRAM(COFIX02C)
DEFINE PROGRAM(FIXA01C) GROUP(FIX)
DEFINE MAPSET(FIXSET) GROUP(FIX) STATUS(ENABLED)
"""
}
DBD = {
    "FIXDB.dbd": """\
      DBD NAME=FIXDB,ACCESS=(HIDAM,VSAM)
      SEGM NAME=ROOTSEG,BYTES=100
      FIELD NAME=(ROOTKEY,SEQ,U),START=1,BYTES=8,TYPE=C
      FIELD NAME=ROOTVAL,START=9,BYTES=4
      SEGM NAME=CHILDSEG,PARENT=ROOTSEG,BYTES=50
      LCHILD NAME=(INDXSEG,INDXDB)
"""
}
DDL = {
    "FIX.ddl": """\
CREATE TABLE FIX.ACCOUNT (
  ACCT_ID CHAR(11) NOT NULL,
  BALANCE DECIMAL(9,2),
  OPENED DATE,
  PRIMARY KEY (ACCT_ID),
  FOREIGN KEY (OWNER) REFERENCES FIX.CUSTOMER (CUST_ID)
);
CREATE UNIQUE INDEX FIX.XACCT ON FIX.ACCOUNT (ACCT_ID);
"""
}
ASM = {"FIXDATE.asm": "* DATE ROUTINE\nFIXDATE CSECT\n        USING *,15\nFIXALT  ENTRY\n", "FIXWAIT.asm": "FIXWAIT START 0\n"}
#: Bounded contexts: order, name, member.
CONTEXTS = [(1, "Intake", "FIXA01C"), (2, "Batch", "FIXA01C"), (3, "Screens", "COFIX02C")]


def lines(spark: SparkSession, texts: dict[str, str], key: str = "source_file") -> DataFrame:
    return line_table(spark.createDataFrame(list(texts.items()), f"{key} string, text string"), key=key)


def sources(spark: SparkSession) -> Sources:
    return Sources(
        programs=lines(spark, PROGRAMS), copybooks=lines(spark, COPYBOOKS, "name"), jcl=lines(spark, JCL), bms=lines(spark, BMS), csd=lines(spark, CSD), dbd=lines(spark, DBD),
        ddl=spark.createDataFrame(list(DDL.items()), "source_file string, text string"),
    )
